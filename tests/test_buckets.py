import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from carelake.operators.ranking import with_positions
from carelake.plans.corpus import update_index
from carelake.plans.medallion import run_gold, truncate_patients
from carelake.schemas import ABSTRACT_SCHEMA, PATIENT_SCHEMA
from carelake.sources.articles import write_corpus
from carelake.sources.tables import BUCKET, create_bucketed, read_table, save_table, upsert_bucketed
from carelake.streaming.silver_stream import merge_batch, read_refreshed, refresh_silver

DAY = dt.date(2024, 1, 1)
BRONZE = "mrn string, age int, sex string, admission_date date, discharge_date date, primary_diagnosis string, readmitted_30d boolean, ingested_at timestamp, source_file string"


def files(path):
    """Name and time of every data file."""
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*/*.parquet")}


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).select("id", F.lit("old").alias("v"))
    assert create_bucketed(spark, path, rows.schema, 16) and not create_bucketed(spark, path, rows.schema, 4)
    assert upsert_bucketed(rows, path, "id") == 200
    before = files(path)
    more = spark.createDataFrame([(7, "new"), (500, "new")], "id long, v string")
    upsert_bucketed(more, path, "id")
    table = read_table(spark, path)
    assert {r.id: r.v for r in table.collect()} == {i: "old" for i in range(200)} | {7: "new", 500: "new"}
    touched = {r[BUCKET] for r in table.where("v = 'new'").select(BUCKET).collect()}
    kept = {p: t for p, t in before.items() if int(p.parent.name.split("=")[1]) not in touched}
    assert kept and kept.items() <= files(path).items()
    upsert_bucketed(more, path, "id")  # a second run changes nothing
    assert read_table(spark, path).count() == 201
    assert upsert_bucketed(more.limit(0), path, "id") == 0
    with pytest.raises(ValueError, match="does not fit"):
        upsert_bucketed(more.withColumn("w", F.lit(1)), path, "id")
    with pytest.raises(ValueError, match="not a bucketed table"):
        upsert_bucketed(more, str(tmp_path / "none"), "id")


def test_last_entry_of_a_pmid_stays(spark, tmp_path):
    rows = [(str(i % 5), f"title {i}", "a", "J", "2020", ["x"], "q") for i in range(40)]
    rows += [("9", f"hot {i}", "a", "J", "2020", ["x"], "q") for i in range(60)]
    write_corpus(spark.createDataFrame(rows, ABSTRACT_SCHEMA).coalesce(1), str(tmp_path / "c"))
    index = str(tmp_path / "index")
    assert update_index(spark, str(tmp_path / "c"), index, buckets=4) == 100
    got = {r.pmid: r.title for r in read_table(spark, index).collect()}
    assert got == {str(i % 5): f"title {i}" for i in range(35, 40)} | {"9": "hot 59"}


def bronze(spark, *rows):
    full = [(m, a, "f", DAY, DAY, None, True, dt.datetime(2024, 1, 1, h), f"{h}.csv") for m, a, h in rows]
    return spark.createDataFrame(full, BRONZE)


def test_silver_batches_come_in_any_order_and_twice(spark, tmp_path):
    path = str(tmp_path / "silver")
    late = bronze(spark, ("A", 50, 9), ("B", 300, 1), (None, 1, 1))
    early = bronze(spark, ("A", 40, 2), ("A", 41, 1), ("C", 60, 5))
    merge_batch(late, path, batch_id=0, buckets=8)
    merge_batch(early, path, batch_id=1)
    want = {("A", 50), ("B", None), ("C", 60)}
    got = lambda: {(r.mrn, r.age) for r in read_refreshed(spark, path).collect()}
    assert got() == want
    before = files(path)
    assert merge_batch(early, path, batch_id=1) == 0 and files(path) == before
    merge_batch(late, path)  # without an id it is merged again
    assert got() == want
    merge_batch(late.limit(0), path)
    assert got() == want


def test_stream_reads_each_file_once(spark, tmp_path):
    source, silver, log = (str(tmp_path / n) for n in ("bronze", "silver", "log"))
    save_table(bronze(spark, ("A", 40, 1), ("B", 50, 1)).coalesce(1), source)
    assert refresh_silver(spark, source, silver, log, 1, buckets=4) == 2
    assert refresh_silver(spark, source, silver, log, 1) == 0
    save_table(bronze(spark, ("A", 41, 2), ("A", 39, 0), ("C", 1, 2)).repartition(3), source)
    assert refresh_silver(spark, source, silver, log, 1) == 3
    assert {(r.mrn, r.age) for r in read_refreshed(spark, silver).collect()} == {("A", 41), ("B", 50), ("C", 1)}


def patients(spark, *mrns):
    return spark.createDataFrame([(m, 65, "M", DAY, DAY, None, False) for m in mrns], PATIENT_SCHEMA).select(
        "*", F.current_timestamp().alias("ingested_at"), F.lit("f.csv").alias("source_file")
    )


def load(spark, tmp_path, mode, *mrns, **options):
    save_table(patients(spark, *mrns), str(tmp_path / "silver"), "overwrite")
    return run_gold(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), mode=mode, **options)


def ids(spark, tmp_path):
    return {r.mrn: r.id for r in read_table(spark, str(tmp_path / "gold")).collect()}


def test_gold_ids_go_on_and_start_anew(spark, tmp_path):
    assert load(spark, tmp_path, "append", "A", "B", "C") == 3  # the table is not there yet
    first = ids(spark, tmp_path)
    assert sorted(first.values()) == [1, 2, 3]
    rest = str(tmp_path / "rest")
    assert load(spark, tmp_path, "append", "B", "D", "E", quarantine_path=rest) == 2
    second = ids(spark, tmp_path)
    assert first.items() <= second.items() and sorted(second.values()) == [1, 2, 3, 4, 5]
    assert [(r.mrn, r.reasons) for r in read_table(spark, rest).collect()] == [("B", ["mrn_duplicate"])]
    assert load(spark, tmp_path, "append") == 0 and load(spark, tmp_path, "ignore", "Z") == 0
    # ids of rows that are gone are not given again
    gold = str(tmp_path / "gold")
    kept = spark.createDataFrame(read_table(spark, gold).where("id < 4").collect(), read_table(spark, gold).schema)
    save_table(kept, gold, "overwrite")
    load(spark, tmp_path, "append", "F")
    assert ids(spark, tmp_path)["F"] == 6
    truncate_patients(spark, gold)
    load(spark, tmp_path, "append", "G")
    assert ids(spark, tmp_path) == {"G": 1}
    load(spark, tmp_path, "overwrite", "H", "I")
    assert sorted(ids(spark, tmp_path).values()) == [1, 2]
    assert all(r.created_at for r in read_table(spark, gold).collect())


def test_gold_reads_silver_once(spark, tmp_path, monkeypatch):
    from carelake.plans import medallion

    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = patients(spark, "A", "B", "C", "C").unionByName(patients(spark, "D").withColumn("age", F.lit(None).cast("int")))
    save_table(rows, str(tmp_path / "silver"))
    read = medallion.read_silver
    monkeypatch.setattr(medallion, "read_silver", lambda *a: (lambda df: df.mapInArrow(counting, df.schema))(read(*a)))
    written = run_gold(
        spark, str(tmp_path / "silver"), str(tmp_path / "gold"),
        quarantine_path=str(tmp_path / "rest"), lineage_path=str(tmp_path / "lineage"),
    )
    assert (written, seen.value) == (3, 5)
    assert sorted(r.mrn for r in read_table(spark, str(tmp_path / "rest")).collect()) == ["C", "D"]
    assert read_table(spark, str(tmp_path / "lineage")).count() == 5


def test_positions_follow_the_files(spark, tmp_path):
    expected = []
    for name, n in (("a.csv", 700), ("b.csv", 1), ("c.csv", 3000), ("d.csv", 0)):
        lines = [f"{name}-{i}" for i in range(n)]
        (tmp_path / name).write_text("\n".join(["mrn", *lines]) + "\n")
        expected += lines
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = spark.read.schema("mrn string").option("header", True).csv(str(tmp_path / "*.csv"))
        assert rows.rdd.getNumPartitions() > 5
        got = with_positions(rows).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.mrn for r in sorted(got, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in got) == list(range(3701))
