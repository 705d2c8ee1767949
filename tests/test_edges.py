"""Rules for odd input: nulls, part dates, repeated keys, second loads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake import runtime
from carelake.functions.clinical import age_descriptor, clinical_query, stay_descriptor
from carelake.operators.cleanse import bronze_to_silver
from carelake.operators.contract import split_requests
from carelake.operators.dedupe import first_query_wins
from carelake.operators.mutate import insert_patients
from carelake.operators.nearest import top_k
from carelake.plans.corpus import index_corpus
from carelake.plans.medallion import run_gold
from carelake.schemas import PATIENT_SCHEMA
from carelake.sources.bronze import ingest_raw_csv, read_bronze
from carelake.sources.tables import read_table, save_table

DAY = dt.date(2023, 2, 1)


def patient(mrn, age=50, sex="F", label=False):
    return (mrn, age, sex, DAY, DAY, "J44.9", label)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    assert runtime.runs_in_one_process("local[8]") and runtime.runs_in_one_process("local")
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077", "k8s://https://host"):
        assert not runtime.runs_in_one_process(master)


def test_scratch_is_removed(spark, tmp_path):
    path = runtime.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    runtime.remove_scratch(spark)
    again = runtime.scratch_path(spark, "new")
    spark.range(3).write.parquet(again)
    assert spark.read.parquet(again).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_insert_names_the_rules_and_all_conflicts(spark):
    stored = spark.createDataFrame([(1, "A")], "id long, mrn string")
    broken = spark.createDataFrame([patient(None), patient("B", age=None), patient("C", sex=None), patient("D")], PATIENT_SCHEMA)
    with pytest.raises(ValueError, match="age_missing 1, mrn_missing 1, sex_missing 1"):
        insert_patients(stored, broken)
    many = spark.createDataFrame([patient(f"M{i:02}") for i in range(30)] * 2, PATIENT_SCHEMA)
    with pytest.raises(ValueError, match="M19 and 10 more"):
        insert_patients(stored, many)
    fine = insert_patients(stored, spark.createDataFrame([patient("B"), patient("C")], PATIENT_SCHEMA))
    assert sorted(r.id for r in fine.collect()) == [2, 3]


def test_a_second_load_keeps_mrns_unique(spark, tmp_path):
    names = ["silver", "gold", "quarantine"]
    silver, gold, quarantine = (str(tmp_path / n) for n in names)
    for load in ([patient("A"), patient("B")], [patient("B", age=51), patient("C")]):
        rows = spark.createDataFrame(load, PATIENT_SCHEMA)
        rows = rows.withColumns({"ingested_at": F.current_timestamp(), "source_file": F.lit("f")})
        save_table(rows, silver, "overwrite")
        run_gold(spark, silver, gold, quarantine_path=quarantine, mode="append")
    assert sorted(r.mrn for r in read_table(spark, gold).collect()) == ["A", "B", "C"]
    again = read_table(spark, quarantine).collect()
    assert [(r.mrn, r.age, r.reasons, r.copies) for r in again] == [("B", 51, ["mrn_duplicate"], 1)]


def test_a_part_of_a_date_is_no_date(spark):
    days = ["2024", "2024-06", "2024-06-15", " 2024-06-15 ", "2024-06-15T10:00", "2024-02-30", None]
    rows = [(f"M{i}", 50, "F", d, "2024-07-01", None) for i, d in enumerate(days)]
    names = "mrn string, age int, sex string, admission_date string, discharge_date string, primary_diagnosis string"
    accepted, rejected = split_requests(spark.createDataFrame(rows, names))
    assert sorted(r.mrn for r in accepted.collect()) == ["M2", "M3"]
    assert {tuple(r.reasons) for r in rejected.collect()} == {("admission_date",)}


def test_inferred_files_reach_silver(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    text = "mrn,age,sex,admission_date,discharge_date,primary_diagnosis,readmitted_30d\n0017,61,m,2023-01-02,2023-01-05,,true\n"
    (tmp_path / "raw" / "a.csv").write_text(text)
    ingest_raw_csv(spark, str(tmp_path / "raw"), str(tmp_path / "bronze"), infer=True)
    row = bronze_to_silver(read_bronze(spark, str(tmp_path / "bronze"))).first()
    assert (row.mrn, row.age, row.sex) == ("0017", 61, "M")


def test_null_descriptors(spark):
    rows = spark.createDataFrame([(None, None)], "age int, days int")
    got = rows.select(age_descriptor(F.col("age")), stay_descriptor(F.col("days"))).first()
    assert tuple(got) == (None, None)
    rows = spark.createDataFrame([(None, DAY, DAY), (50, None, DAY), (50, DAY, DAY)], "age int, a date, b date")
    texts = [r[0] for r in rows.select(clinical_query(F.col("age"), F.col("a"), F.col("b"), F.lit("J44.9"))).collect()]
    assert texts[:2] == [None, None] and texts[2]


@pytest.mark.parametrize("limits", [{}, {"broadcast_values": 6}, {"broadcast_values": 1, "block_values": 4}])
def test_vectors_without_direction_are_no_neighbours(spark, limits):
    nan, inf = float("nan"), float("inf")
    good = [("d1", [1.0, 0.0]), ("d2", [0.9, 0.1]), ("d3", [0.0, 1.0])]
    odd = [("n1", [nan, 1.0]), ("n2", [inf, 1.0]), ("n3", None), ("n4", []), ("n5", [None, 1.0])]
    docs = spark.createDataFrame(good + odd, "document_key string, vector array<double>")
    asks = spark.createDataFrame([("q", [1.0, 0.0]), ("bad", [nan, 0.0]), ("none", None)], "query_key string, vector array<double>")
    got = top_k(asks, docs, 2, **limits).orderBy("rank").collect()
    assert [(r.query_key, r.document_key) for r in got] == [("q", "d1"), ("q", "d2")]


def test_null_query_numbers_come_last(spark):
    rows = [("1", None, 1, "late"), ("1", 4, 9, "first"), ("2", None, 2, "b"), ("2", None, 1, "a")]
    found = spark.createDataFrame(rows, "pmid string, query_no int, position int, title string")
    assert {r.pmid: r.title for r in first_query_wins(found).collect()} == {"1": "first", "2": "a"}


def test_the_last_entry_of_a_corpus_wins(spark, tmp_path):
    lines = ['{"pmid": "%s", "title": "t%d", "abstract": "words here", "authors": []}' % ("5" if i % 2 else "6", i) for i in range(6)]
    (tmp_path / "corpus").mkdir()
    (tmp_path / "corpus" / "a.json").write_text("\n".join(lines))
    (tmp_path / "corpus" / "b.json").write_text('{"pmid": "6", "title": "newest", "abstract": "x", "authors": []}')
    assert index_corpus(spark, str(tmp_path / "corpus"), str(tmp_path / "index")) == 7
    assert {r.pmid: r.title for r in read_table(spark, str(tmp_path / "index")).collect()} == {"5": "t5", "6": "newest"}
