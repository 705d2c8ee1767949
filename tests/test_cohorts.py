import datetime as dt

import pytest

from carelake.operators import cohorts
from carelake.operators.mutate import (
    count_deleted,
    delete_by_ids,
    duplicate_mrns,
    insert_patients,
    new_articles,
    new_patients,
    upsert,
    with_ids,
)
from carelake.schemas import PATIENT_SCHEMA, STORED_PATIENT_SCHEMA

TODAY = dt.date(2024, 7, 1)


def row(mrn, age=65, start=TODAY, dx="I50.9", label=False):
    return (mrn, age, "M", start, start, dx, label)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PATIENT_SCHEMA)


def mrns(df):
    return [r.mrn for r in df.collect()]


@pytest.fixture(scope="module")
def by_code(spark):
    codes = {"HF1": "I50.9", "HF2": "I50.9", "PN1": "J18.9", "MI1": "I21.9", "ST1": "I63.9"}
    return frame(spark, *[row(m, dx=c) for m, c in codes.items()]).cache()


def test_named_cohorts(by_code):
    assert mrns(cohorts.heart_failure_cohort(by_code)) == ["HF1", "HF2"]
    assert mrns(cohorts.cardiovascular_cohort(by_code)) == ["HF1", "HF2", "MI1", "ST1"]
    assert mrns(cohorts.named_cohort(by_code, "pneumonia")) == ["PN1"]
    assert mrns(cohorts.named_cohort(by_code, "diabetes")) == []


def test_no_codes_no_rows(by_code):
    assert mrns(cohorts.find_by_diagnoses(by_code, [])) == []


def test_range_is_inclusive_and_ordered(spark):
    days = {"BEFORE": (2023, 12, 31), "LAST": (2024, 1, 31), "FIRST": (2024, 1, 1), "AFTER": (2024, 2, 1)}
    rows = frame(spark, *[row(m, start=dt.date(*d)) for m, d in days.items()])
    assert mrns(cohorts.admissions_between(rows, "2024-01-01", "2024-01-31")) == ["FIRST", "LAST"]
    assert mrns(cohorts.find_by_diagnoses(rows, ["I50.9"], end="2024-01-01")) == ["BEFORE", "FIRST"]
    assert mrns(cohorts.find_by_diagnoses(rows, ["I50.9"], start="2024-02-01")) == ["AFTER"]


def test_recent(spark):
    rows = frame(
        spark,
        row("NEW", start=TODAY - dt.timedelta(days=5)),
        row("OLD", start=TODAY - dt.timedelta(days=120)),
        row("EDGE", start=TODAY - dt.timedelta(days=30)),
        row("FUTURE", start=TODAY + dt.timedelta(days=1)),
    )
    assert mrns(cohorts.recent_admissions(rows, 30, TODAY)) == ["EDGE", "NEW"]


def test_recent_defaults_to_today(spark):
    rows = frame(spark, row("NEW", start=dt.date.today()), row("OLD", start=dt.date(2000, 1, 1)))
    assert mrns(cohorts.recent_admissions(rows)) == ["NEW"]


def test_elderly(spark):
    rows = frame(
        spark, row("A", 65), row("B", 85), row("C", 64), row("D", 90, dt.date(2030, 1, 1)), row("E", None)
    )
    assert mrns(cohorts.elderly_cohort(rows, TODAY)) == ["A", "B"]


def test_summary(spark):
    rows = frame(spark, *[row(str(i), label=i < 2) for i in range(4)])
    assert tuple(cohorts.summarize_cohort("x", rows).first()) == ("x", 4, 2, 0.5)
    assert tuple(cohorts.summarize_cohort("x", rows.limit(0)).first()) == ("x", 0, 0, 0.0)
    assert cohorts.readmission_rate(rows).first()[0] == 0.5
    assert cohorts.readmission_rate(rows.limit(0)).first()[0] == 0.0
    assert cohorts.count_patients(rows) == 4


def test_all_summaries_agree_with_single_ones(by_code):
    got = {r.name: tuple(r) for r in cohorts.summarize_named_cohorts(by_code, TODAY).collect()}
    for name in ("heart_failure", "cardiovascular", "copd"):
        cohort = cohorts.named_cohort(by_code, name)
        assert got[name] == tuple(cohorts.summarize_cohort(name, cohort).first())
    assert got["elderly"][1] == 5 and got["recent"][1] == 5


def test_insert_numbers_rows_and_finds_them(spark):
    first = insert_patients(spark.createDataFrame([], STORED_PATIENT_SCHEMA), frame(spark, row("A"), row("B")))
    assert sorted(r.id for r in first.collect()) == [1, 2]
    assert all(r.created_at is not None for r in first.collect())
    more = insert_patients(first, frame(spark, *[row(f"N{i}") for i in range(50)]))
    assert sorted(r.id for r in more.collect()) == list(range(3, 53))
    table = first.unionByName(more)
    assert cohorts.find_by_mrn(table, "B").count() == 1
    one = cohorts.find_by_mrn(table, "N7").first()
    assert cohorts.find_by_id(table, one.id).first().mrn == "N7"
    assert cohorts.find_by_id(table, 999).first() is None
    assert cohorts.find_by_mrn(table, "nobody").first() is None


def test_duplicate_mrn_is_an_error(spark):
    stored = with_ids(None, frame(spark, row("A")))
    with pytest.raises(ValueError, match="duplicate mrn: A"):
        insert_patients(stored, frame(spark, row("A"), row("B")))
    with pytest.raises(ValueError, match="duplicate mrn: C"):
        insert_patients(stored, frame(spark, row("C"), row("C")))
    batch = frame(spark, row("A"), row("B"), row("C"), row("C", age=3))
    assert sorted(mrns(duplicate_mrns(stored, batch))) == ["A", "C"]
    assert sorted(mrns(new_patients(stored, batch))) == ["B", "C"]


def test_delete_twice(spark):
    table = with_ids(None, frame(spark, row("A"), row("B")))
    gone = cohorts.find_by_mrn(table, "A")
    assert count_deleted(table, gone) == 1
    rest = delete_by_ids(table, gone)
    assert mrns(rest) == ["B"]
    assert count_deleted(rest, gone) == 0


def test_upsert_replaces_and_is_idempotent(spark):
    stored = spark.createDataFrame([("1", "old"), ("2", "kept")], "pmid string, title string")
    batch = spark.createDataFrame(
        [("1", "older", 1), ("1", "new", 2), ("3", "added", 1)], "pmid string, title string, no int"
    )
    want = {("1", "new"), ("2", "kept"), ("3", "added")}
    once = upsert(stored, batch, "pmid", "no")
    assert {tuple(r) for r in once.collect()} == want
    twice = upsert(once, batch, "pmid", "no")
    assert sorted(map(tuple, twice.collect())) == sorted(want)
    assert [r.pmid for r in new_articles(stored, once).collect()] == ["3"]
