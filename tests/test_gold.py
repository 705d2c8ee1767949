import datetime as dt
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from carelake.fixed_values import PATIENT_COLUMNS
from carelake.operators.cohorts import admissions_between, elderly_cohort
from carelake.operators.contract import (
    project_patient,
    repeats_mrn,
    split_gold,
    split_requests,
)
from carelake.plans.medallion import run_gold
from carelake.schemas import PATIENT_SCHEMA
from carelake.sources import jdbc
from carelake.sources.tables import read_table, save_table

DAY = dt.date(2024, 1, 1)


def row(mrn="A", age=65, sex="M", start=DAY, end=DAY, dx="I50.9", label=False):
    return (mrn, age, sex, start, end, dx, label)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), PATIENT_SCHEMA)


def with_lineage(df):
    return df.select(
        F.lit("a.csv").alias("source_file"), F.current_timestamp().alias("ingested_at"), *df.columns[::-1]
    )


def test_projection_order(spark):
    assert project_patient(with_lineage(frame(spark, row()))).columns == PATIENT_COLUMNS


@pytest.mark.parametrize(
    "bad, reason",
    [
        (row(mrn=None), "mrn_missing"),
        (row(mrn="x" * 65), "mrn_too_long"),
        (row(age=None), "age_missing"),
        (row(sex=None), "sex_missing"),
        (row(sex="MM"), "sex_too_long"),
        (row(start=None), "admission_date_missing"),
        (row(end=None), "discharge_date_missing"),
        (row(dx="x" * 11), "diagnosis_too_long"),
        (row(label=None), "readmitted_missing"),
    ],
)
def test_reject_reasons(spark, bad, reason):
    accepted, rejected = split_gold(frame(spark, row("OK", dx=None), bad))
    assert [r.mrn for r in accepted.collect()] == ["OK"]
    assert [(r.reasons, r.copies) for r in rejected.collect()] == [([reason], 1)]


def test_repeated_mrn_leaves_one_and_counts_the_rest(spark):
    rows = [row("A")] * 5 + [row("A", age=40)] * 2 + [row("B"), row("A", age=None)]
    accepted, rejected = split_gold(frame(spark, *rows))
    assert sorted((r.mrn, r.age) for r in accepted.collect()) == [("A", 65), ("B", 65)]
    copies = {(r.age, r.reasons[0]): r.copies for r in rejected.collect()}
    assert copies == {
        (65, "mrn_duplicate"): 4,
        (40, "mrn_duplicate"): 2,
        (None, "age_missing"): 1,
    }


def test_job_loads_replaces_and_quarantines(spark, tmp_path):
    silver, gold, rest = (str(tmp_path / n) for n in ("silver", "gold", "rest"))
    save_table(with_lineage(frame(spark, row("A"), row("B"), row("C", age=None))), silver)
    assert run_gold(spark, silver, gold, quarantine_path=rest) == 2
    assert [r.mrn for r in read_table(spark, rest).collect()] == ["C"]
    save_table(with_lineage(frame(spark, row("D"))), silver, mode="overwrite")
    assert run_gold(spark, silver, gold, lineage_path=str(tmp_path / "lineage")) == 1
    assert [r.mrn for r in read_table(spark, gold).collect()] == ["D"]
    assert read_table(spark, str(tmp_path / "lineage")).columns == [
        "mrn",
        "ingested_at",
        "source_file",
    ]


@pytest.mark.parametrize("scheme", ["postgresql://", "postgresql+psycopg://"])
def test_database_url(scheme):
    url = f"{scheme}app:s@cr:et@db.example:5432/care"
    assert jdbc.jdbc_url(url) == "jdbc:postgresql://db.example:5432/care"
    assert jdbc.credentials(url) == ("app", "s@cr:et")
    assert jdbc.redact_url(url) == f"{scheme}app:***@db.example:5432/care"


@pytest.mark.parametrize("url", ["postgresql://db/care", "postgresql://app@db/care"])
def test_missing_credentials(url):
    assert jdbc.jdbc_url(url) == "jdbc:postgresql://db/care"
    with pytest.raises(ValueError):
        jdbc.credentials(url)
    assert jdbc.redact_url(url) == url


def test_other_databases_are_refused():
    with pytest.raises(ValueError, match="mysql://u:\\*\\*\\*@h"):
        jdbc.jdbc_url("mysql://u:p@h/db")


def test_redacted_column(spark):
    urls = ["postgresql://u:p@h/db", "postgresql://u:p@q@h/db", "postgresql://u@h/db", "plain"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r[0] for r in df.select(jdbc.redacted(F.col("url"))).collect()]
    assert got == [jdbc.redact_url(u) for u in urls]


def test_jdbc_write_truncates_and_bounds_connections():
    df = MagicMock()
    chain = df.write.format.return_value
    for step in ("options", "option", "mode"):
        getattr(chain, step).return_value = chain
    jdbc.write_jdbc(df, "patient", "postgresql://u:p@h/db", connections=4)
    df.write.format.assert_called_once_with("jdbc")
    assert chain.options.call_args.kwargs["dbtable"] == "patient"
    chain.option.assert_any_call("truncate", "true")
    chain.option.assert_any_call("numPartitions", "4")
    chain.mode.assert_called_once_with("overwrite")
    chain.save.assert_called_once()


def test_jdbc_read_is_split_by_id():
    session = MagicMock()
    chain = session.read.format.return_value
    for step in ("options", "option"):
        getattr(chain, step).return_value = chain
    jdbc.read_jdbc(session, "patient", "postgresql://u:p@h/db", id_bounds=(1, 900))
    chain.option.assert_any_call("partitionColumn", "id")
    chain.option.assert_any_call("upperBound", "900")


REQUEST = "mrn string, age string, sex string, admission_date string, discharge_date string, primary_diagnosis string"


@pytest.mark.parametrize(
    "request_row, reasons",
    [
        (("A", "78", "M", "2024-06-15", "2024-06-22", None), None),
        (("A", "500", "M", "2024-06-15", "2024-06-22", None), ["age"]),
        (("A", "x", "M", "2024-06-15", "2024-06-22", None), ["age"]),
        (("A", "78", "X", "2024-06-15", "2024-06-22", None), ["sex"]),
        (("A", "78", "m", "2024-06-15", "2024-06-22", None), ["sex"]),
        (("", "78", "M", "2024-06-15", "2024-06-22", None), ["mrn"]),
        ((None, None, None, None, "soon", "x" * 11), ["mrn", "age", "sex", "admission_date", "discharge_date", "primary_diagnosis"]),
    ],
)
def test_request_contract(spark, request_row, reasons):
    accepted, rejected = split_requests(spark.createDataFrame([request_row], REQUEST))
    assert [r.reasons for r in rejected.collect()] == ([reasons] if reasons else [])
    assert accepted.count() == (0 if reasons else 1)
    assert dict(accepted.dtypes)["admission_date"] == "date"


def test_unique_rows_do_not_move(spark):
    rows = frame(spark, row("A"), row("B"), row("C", age=None))
    assert not repeats_mrn(rows) and repeats_mrn(rows.union(rows))
    accepted, rejected = split_gold(rows, mrn_is_unique=True)
    assert "Exchange" not in accepted._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.mrn for r in accepted.collect()) == ["A", "B"]
    assert [(r.mrn, r.copies) for r in rejected.collect()] == [("C", 1)]


def test_months_are_skipped(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    save_table(with_lineage(frame(spark, *[row(str(d), start=d) for d in days])), silver)
    assert run_gold(spark, silver, gold, by_month=True) == 4
    table = read_table(spark, gold)
    january = admissions_between(table, "2024-01-01", "2024-01-31")
    assert [r.mrn for r in january.collect()] == ["2024-01-01", "2024-01-31"]
    plan = january._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :]
    assert "admission_month" in filters[: filters.index("]")]
    assert elderly_cohort(table, "2024-01-15").count() == 2
