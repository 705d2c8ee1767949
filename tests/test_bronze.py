import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from carelake.schemas import CORRUPT_RECORD, PATIENT_SCHEMA
from carelake.sources.bronze import ingest_raw_csv, read_bronze, read_csv
from carelake.sources.tables import (
    create_if_absent,
    read_table,
    save_table,
    table_exists,
    truncate_table,
)
from carelake.streaming.bronze_stream import ingest_new_files

HEADER = "mrn,age,sex,admission_date,discharge_date,primary_diagnosis,readmitted_30d"
ROW_1 = "B-17,58,F,2023-05-03,2023-05-11,J44.9,true"
ROW_2 = "B-18,77,M,2023-08-21,2023-08-30,,false"


def put(folder, name, *rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *rows]) + "\n")


@pytest.fixture
def raw(tmp_path):
    put(tmp_path / "raw", "a.csv", ROW_1, ROW_2)
    return tmp_path / "raw"


def test_rows_types_and_lineage(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    assert ingest_raw_csv(spark, str(raw), out, mode="overwrite") == 2
    rows = {r.mrn: r for r in read_bronze(spark, out).collect()}
    assert rows["B-17"].age == 58
    assert rows["B-17"].admission_date == dt.date(2023, 5, 3)
    assert rows["B-17"].readmitted_30d is True
    assert rows["B-18"].primary_diagnosis is None
    assert all(r.source_file.endswith("a.csv") for r in rows.values())
    assert all(r.ingested_at is not None for r in rows.values())


def test_append_reads_the_whole_folder_again(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    put(raw, "a.csv", ROW_1)
    assert ingest_raw_csv(spark, str(raw), out, mode="overwrite") == 1
    put(raw, "b.csv", ROW_2)
    assert ingest_raw_csv(spark, str(raw), out, mode="append") == 2
    assert read_bronze(spark, out).count() == 3


def test_ignore_writes_once(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    assert ingest_raw_csv(spark, str(raw), out, mode="ignore") == 2
    assert ingest_raw_csv(spark, str(raw), out, mode="ignore") == 0
    assert read_bronze(spark, out).count() == 2


def test_unknown_mode(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        ingest_raw_csv(spark, str(raw), str(tmp_path / "b"), mode="merge")


def test_malformed_row_keeps_its_text(spark, tmp_path):
    bad = "T-003,old,M,2024-01-15,2024-01-22,I50.9,true"
    put(tmp_path / "raw", "a.csv", ROW_1, bad)
    out = str(tmp_path / "bronze")
    ingest_raw_csv(spark, str(tmp_path / "raw"), out)
    rows = {r.mrn: r[CORRUPT_RECORD] for r in read_bronze(spark, out).collect()}
    assert rows == {"B-17": None, "T-003": bad}


def test_swapped_header_fails(spark, tmp_path):
    header = HEADER.replace("mrn,age", "age,mrn")
    put(tmp_path / "raw", "a.csv", "58,B-17,F,2023-05-03,2023-05-11,J44.9,true", header=header)
    with pytest.raises(Exception, match="(?i)header"):
        ingest_raw_csv(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"))


def test_inference_is_opt_in(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    assert ingest_raw_csv(spark, str(raw), out, infer=True) == 2
    assert dict(read_bronze(spark, out).dtypes)["age"] == "int"


def test_drifted_append_fails_before_writing(spark, raw, tmp_path):
    out = str(tmp_path / "t")
    save_table(spark.createDataFrame([("a", 1)], "mrn string, age int"), out)
    with pytest.raises(ValueError, match="age: table int, batch string"):
        save_table(spark.createDataFrame([("a", "1")], "mrn string, age string"), out)
    assert read_table(spark, out).count() == 1


def test_read_csv(spark, raw, tmp_path):
    assert read_csv(spark, str(raw / "a.csv")).count() == 2
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "missing.csv"))


def test_create_and_truncate(spark, tmp_path):
    path = str(tmp_path / "patient")
    assert create_if_absent(spark, path, PATIENT_SCHEMA)
    assert not create_if_absent(spark, path, PATIENT_SCHEMA)
    row = spark.createDataFrame(
        [("A", 1, "F", dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, False)],
        PATIENT_SCHEMA,
    )
    assert save_table(row, path) == 1
    truncate_table(spark, path, PATIENT_SCHEMA)
    assert read_table(spark, path).count() == 0
    assert table_exists(spark, path)


def test_each_file_lands_once(spark, raw, tmp_path):
    out, log = str(tmp_path / "bronze"), str(tmp_path / "log")
    assert ingest_new_files(spark, str(raw), out, log) == 2
    assert ingest_new_files(spark, str(raw), out, log) == 0
    put(raw, "b.csv", ROW_1)
    assert ingest_new_files(spark, str(raw), out, log, max_files_per_batch=1) == 1
    assert read_bronze(spark, out).count() == 3


def test_stream_and_batch_do_not_share_a_table(spark, raw, tmp_path):
    streamed, batch = str(tmp_path / "s"), str(tmp_path / "b")
    ingest_new_files(spark, str(raw), streamed, str(tmp_path / "log"))
    with pytest.raises(ValueError, match="stream"):
        ingest_raw_csv(spark, str(raw), streamed)
    ingest_raw_csv(spark, str(raw), batch)
    with pytest.raises(ValueError, match="batch"):
        ingest_new_files(spark, str(raw), batch, str(tmp_path / "log2"))


def test_a_large_file_is_dealt_to_many_tasks(spark, tmp_path):
    """A file has many row groups, each of which another task can read."""
    path = str(tmp_path / "t")
    rows = spark.range(2_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    save_table(rows.coalesce(1), path)
    read = spark.read.parquet(path)
    # 8 tasks and splits of 4 MB at least: each of them has its own row groups
    in_tasks = read.groupBy(F.spark_partition_id()).count().count()
    assert in_tasks > 1 and read.count() == 2_000_000
