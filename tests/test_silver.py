import datetime as dt

import pytest

from carelake.operators.cleanse import (
    bronze_to_silver,
    drop_missing_mrn,
    latest_per_mrn,
    normalize_sex,
    validate_age,
)
from carelake.plans.medallion import read_silver, run_silver
from carelake.schemas import RAW_SCHEMA
from carelake.sources.tables import save_table

BRONZE = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA)
BRONZE += ", ingested_at timestamp, source_file string"


def row(mrn="A", age=65, sex="M", seen=dt.datetime(2024, 6, 1), source="a.csv", dx="I50.9"):
    return (mrn, age, sex, dt.date(2024, 1, 1), dt.date(2024, 1, 5), dx, False, seen, source)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def test_latest_wins(spark):
    old = row("DUP", source="original.csv")
    new = row("DUP", seen=dt.datetime(2024, 6, 2), source="corrected.csv")
    got = latest_per_mrn(frame(spark, old, new)).collect()
    assert [r.source_file for r in got] == ["corrected.csv"]


def test_distinct_patients_stay(spark):
    assert latest_per_mrn(frame(spark, row("A"), row("B"))).count() == 2


def test_equal_times_have_one_answer(spark):
    rows = [row("A", age=a, source=s) for a, s in ((1, "b"), (2, "b"), (3, "a"))]
    for order in (rows, rows[::-1]):
        got = latest_per_mrn(frame(spark, *order).repartition(3)).collect()
        assert [(r.age, r.source_file) for r in got] == [(2, "b")]


@pytest.mark.parametrize(
    "age, kept",
    [(65, 65), (0, 0), (120, 120), (-5, None), (500, None), (121, None), (None, None)],
)
def test_age(spark, age, kept):
    assert [r.age for r in validate_age(frame(spark, row(age=age))).collect()] == [kept]


def test_age_as_text(spark):
    ages = spark.createDataFrame([("65",), ("old",), ("500",), (None,)], "age string")
    assert [r.age for r in validate_age(ages).collect()] == [65, None, None, None]


@pytest.mark.parametrize(
    "sex, kept", [("m", "M"), ("F", "F"), ("o", "O"), ("unknown", None), (" M", None), (None, None)]
)
def test_sex(spark, sex, kept):
    assert [r.sex for r in normalize_sex(frame(spark, row(sex=sex))).collect()] == [kept]


def test_rows_without_mrn_go(spark):
    got = drop_missing_mrn(frame(spark, row(None), row(""), row(" "), row("V"))).collect()
    assert sorted(r.mrn for r in got) == [" ", "V"]


def test_whole_transform(spark):
    got = bronze_to_silver(frame(spark, row("A", age=200, sex="f"), row(None))).collect()
    assert [(r.mrn, r.age, r.sex) for r in got] == [("A", None, "F")]


def test_hot_mrn_is_thinned_before_the_shuffle(spark):
    plan = latest_per_mrn(frame(spark, row()))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_job(spark, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    rows = [row("A"), row("A", seen=dt.datetime(2024, 7, 1), age=200), row(None), row("B")]
    save_table(frame(spark, *rows), bronze)
    for _ in range(2):
        counts = run_silver(spark, bronze, silver)
        assert (counts.rows_in, counts.rows_out, counts.dropped) == (4, 2, 2)
    got = {r.mrn: r.age for r in read_silver(spark, silver).collect()}
    assert got == {"A": None, "B": 65}
