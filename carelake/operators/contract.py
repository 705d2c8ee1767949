"""Accept / reject splits on the rules of a table or of a scoring request."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import (
    LABEL,
    MAX_AGE,
    MAX_DIAGNOSIS_LENGTH,
    MAX_MRN_LENGTH,
    MAX_SEX_LENGTH,
    MIN_AGE,
    PATIENT_COLUMNS,
    SEX_VALUES,
)
from .dedupe import keep_latest

REASONS = "reasons"
REQUEST_COLUMNS = [c for c in PATIENT_COLUMNS if c != LABEL]


def split_by_rules(
    df: DataFrame, rules: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the rest with the names of those they break.

    The row test is a plain disjunction, so it compiles and reaches the scan; only
    rejected rows get the array of names.
    """
    breaks = reduce(or_, map(_holds, rules.values()))
    return (
        df.filter(~breaks),
        df.filter(breaks).withColumn(REASONS, broken_rules(rules)),
    )


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that a row breaks."""
    names = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return F.array_compact(F.array(*names))


def project_patient(silver: DataFrame) -> DataFrame:
    """The patient columns in table order, without lineage."""
    return silver.select(*PATIENT_COLUMNS)


def patient_lineage(silver: DataFrame) -> DataFrame:
    return silver.select("mrn", "ingested_at", "source_file")


def repeats_mrn(df: DataFrame) -> bool:
    """Whether an MRN occurs twice; only the MRNs are shuffled, after adding up."""
    counts = df.groupBy("mrn").agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter(F.col("n") > 1).isEmpty()


def split_gold(
    silver: DataFrame, mrn_is_unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows the patient table can hold, and the rest with reasons and a count.

    Of several valid rows with one MRN, one is accepted. The others are counted
    as copies: rows are added up by content before they move, so neither a hot
    MRN nor a group of equal rows meets in one task. With ``mrn_is_unique``, as
    checked by ``repeats_mrn``, no row moves at all.
    """
    valid, invalid = split_by_rules(project_patient(silver), patient_rules())
    one = F.lit(1).cast("long").alias("copies")
    if mrn_is_unique:
        return valid, invalid.select("*", one)
    accepted = keep_latest(valid, ["mrn"], ["admission_date"])
    surplus = (
        valid.select("*", one)
        .unionByName(accepted.select("*", (-F.lit(1).cast("long")).alias("copies")))
        .groupBy(*PATIENT_COLUMNS)
        .agg(F.sum("copies").alias("copies"))
        .filter(F.col("copies") > 0)
        .withColumn(REASONS, F.array(F.lit("mrn_duplicate")))
    )
    return accepted, invalid.select("*", one).unionByName(surplus)


def split_stored(
    accepted: DataFrame, stored: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows whose MRN the table lacks, and the rest as ``mrn_duplicate``."""
    known = stored.select("mrn").distinct()
    again = accepted.join(known, "mrn", "left_semi").select(*PATIENT_COLUMNS)
    return accepted.join(known, "mrn", "left_anti"), again.withColumns(
        {REASONS: F.array(F.lit("mrn_duplicate")), "copies": F.lit(1).cast("long")}
    )


def patient_rules() -> dict[str, Column]:
    """What a row of the patient table must not be, by the name of the rule."""
    return {
        "mrn_missing": F.col("mrn").isNull(),
        "mrn_too_long": F.length("mrn") > MAX_MRN_LENGTH,
        "age_missing": F.col("age").isNull(),
        "sex_missing": F.col("sex").isNull(),
        "sex_too_long": F.length("sex") > MAX_SEX_LENGTH,
        "admission_date_missing": F.col("admission_date").isNull(),
        "discharge_date_missing": F.col("discharge_date").isNull(),
        "diagnosis_too_long": F.length("primary_diagnosis") > MAX_DIAGNOSIS_LENGTH,
        "readmitted_missing": F.col(LABEL).isNull(),
    }


def split_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scoring requests that can be scored, and the rest with reasons.

    A missing diagnosis is fine. Dates and ages that come as text are parsed.
    """
    parsed = requests
    for name, kind in {
        "age": "int",
        "admission_date": "date",
        "discharge_date": "date",
    }.items():
        if isinstance(requests.schema[name].dataType, T.StringType):
            value = F.col(name)
            if kind == "date":  # a year or a month alone is no date
                value = F.when(F.trim(value).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(value))
            parsed = parsed.withColumn(name, value.try_cast(kind))
    return split_by_rules(
        parsed,
        {
            "mrn": ~_holds(F.length("mrn").between(1, MAX_MRN_LENGTH)),
            "age": ~_holds(F.col("age").between(MIN_AGE, MAX_AGE)),
            "sex": ~_holds(F.col("sex").isin(SEX_VALUES)),
            "admission_date": F.col("admission_date").isNull(),
            "discharge_date": F.col("discharge_date").isNull(),
            "primary_diagnosis": F.length("primary_diagnosis") > MAX_DIAGNOSIS_LENGTH,
        },
    )


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def scoring_rows(accepted: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Request columns and ``keep``: the label is unknown when scoring."""
    return accepted.select(*REQUEST_COLUMNS, *keep)
