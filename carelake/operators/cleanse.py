"""Bronze rows to one validated row per patient."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import MAX_AGE, MIN_AGE, SEX_VALUES
from ..schemas import CORRUPT_RECORD
from .dedupe import keep_latest


def drop_missing_mrn(df: DataFrame) -> DataFrame:
    return df.filter(F.col("mrn").isNotNull() & (F.col("mrn").cast("string") != ""))


def validate_age(df: DataFrame) -> DataFrame:
    """Null an age outside the valid range, keep the row."""
    age = F.col("age")
    if isinstance(df.schema["age"].dataType, T.StringType):
        age = age.try_cast("int")
    return df.withColumn("age", F.when(age.between(MIN_AGE, MAX_AGE), age))


def normalize_sex(df: DataFrame) -> DataFrame:
    """Upper-case sex, null anything unlisted, keep the row."""
    sex = F.upper("sex")
    return df.withColumn("sex", F.when(sex.isin(SEX_VALUES), sex))


def latest_per_mrn(df: DataFrame) -> DataFrame:
    latest = [c for c in ("ingested_at", "source_file") if c in df.columns]
    return keep_latest(df, ["mrn"], latest)


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    return (
        bronze.drop(CORRUPT_RECORD)
        .transform(drop_missing_mrn)
        .transform(validate_age)
        .transform(normalize_sex)
        .transform(latest_per_mrn)
    )
