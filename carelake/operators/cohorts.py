"""Patient lookups, named cohorts and their summaries.

Every predicate is a plain column comparison, so it reaches the Parquet or
JDBC scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import COHORT_CODES, ELDERLY_AGE, LABEL, RECENT_DAYS

EPOCH = dt.date(1900, 1, 1)
ADMISSION_MONTH = "admission_month"


def with_admission_month(patients: DataFrame) -> DataFrame:
    """Adds the partition column of a table that is laid out by month."""
    return patients.withColumn(ADMISSION_MONTH, _month(F.col("admission_date")))


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def _admitted(patients: DataFrame, start=None, end=None) -> DataFrame:
    """Rows in a date range, either end open; whole months are skipped if stored so."""
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is None:
            continue
        patients = patients.filter(keep(F.col("admission_date"), _date(bound)))
        if ADMISSION_MONTH in patients.columns:
            patients = patients.filter(keep(F.col(ADMISSION_MONTH), _month(_date(bound))))
    return patients


def find_by_id(patients: DataFrame, patient_id: int) -> DataFrame:
    return patients.filter(F.col("id") == patient_id)


def find_by_mrn(patients: DataFrame, mrn: str) -> DataFrame:
    return patients.filter(F.col("mrn") == mrn)


def admissions_between(patients: DataFrame, start, end) -> DataFrame:
    """Both ends inclusive, in admission order."""
    return _in_admission_order(_admitted(patients, start, end))


def find_by_diagnoses(
    patients: DataFrame, codes: Sequence[str], start=None, end=None
) -> DataFrame:
    if not codes:
        return patients.limit(0)
    found = patients.filter(F.col("primary_diagnosis").isin(list(codes)))
    return _in_admission_order(_admitted(found, start, end))


def named_cohort(patients: DataFrame, name: str, start=None, end=None) -> DataFrame:
    return find_by_diagnoses(patients, COHORT_CODES[name], start, end)


def heart_failure_cohort(patients: DataFrame, start=None, end=None) -> DataFrame:
    return named_cohort(patients, "heart_failure", start, end)


def cardiovascular_cohort(patients: DataFrame, start=None, end=None) -> DataFrame:
    return named_cohort(patients, "cardiovascular", start, end)


def recent_admissions(
    patients: DataFrame, days: int = RECENT_DAYS, as_of=None
) -> DataFrame:
    today = F.current_date() if as_of is None else _date(as_of)
    return admissions_between(patients, F.date_sub(today, days), today)


def elderly_cohort(patients: DataFrame, as_of=None) -> DataFrame:
    """Aged 65 or more and admitted no later than ``as_of``."""
    today = F.current_date() if as_of is None else _date(as_of)
    return admissions_between(
        patients.filter(F.col("age") >= ELDERLY_AGE), EPOCH, today
    )


def count_patients(patients: DataFrame) -> int:
    return patients.count()


def readmission_rate(patients: DataFrame) -> DataFrame:
    return patients.agg(
        F.coalesce(F.avg(F.col(LABEL).cast("double")), F.lit(0.0)).alias("readmit_rate")
    )


def summarize_cohort(name: str, cohort: DataFrame) -> DataFrame:
    return cohort.agg(*_summary_columns()).select(
        F.lit(name).alias("name"), "n_patients", "n_readmitted", "readmit_rate"
    )


def summarize_named_cohorts(patients: DataFrame, as_of=None) -> DataFrame:
    """All cohorts in one scan: a patient may be in several of them."""
    today = F.current_date() if as_of is None else _date(as_of)
    member = {
        name: F.col("primary_diagnosis").isin(codes)
        for name, codes in COHORT_CODES.items()
    }
    member["recent"] = F.col("admission_date").between(
        F.date_sub(today, RECENT_DAYS), today
    )
    member["elderly"] = (F.col("age") >= ELDERLY_AGE) & F.col(
        "admission_date"
    ).between(_date(EPOCH), today)
    totals = patients.agg(
        *[
            F.struct(*_summary_columns(belongs)).alias(name)
            for name, belongs in member.items()
        ]
    )
    rows = [F.struct(F.lit(n).alias("name"), f"{n}.*") for n in member]
    return totals.select(F.inline(F.array(*rows)))


def _summary_columns(belongs: Column | None = None) -> list[Column]:
    belongs = F.lit(True) if belongs is None else belongs
    n = F.count_if(belongs)
    positive = F.count_if(belongs & F.col(LABEL))
    return [
        n.alias("n_patients"),
        positive.alias("n_readmitted"),
        F.coalesce(F.try_divide(positive, n), F.lit(0.0)).alias("readmit_rate"),
    ]


def _in_admission_order(df: DataFrame) -> DataFrame:
    tie = "id" if "id" in df.columns else "mrn"
    return df.orderBy("admission_date", tie)


def _date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")
