"""The model's feature columns, as one narrow projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import AGE_BUCKETS, DIAGNOSIS_VALUES, LABEL, SEX_VALUES
from ..functions.clinical import age_bucket, known_diagnosis, length_of_stay_days


def feature_names() -> list[str]:
    return [
        "age",
        "length_of_stay_days",
        *[f"sex_{v}" for v in SEX_VALUES],
        *[f"dx_{v}" for v in DIAGNOSIS_VALUES],
        *[f"age_bucket_{v}" for v in AGE_BUCKETS],
    ]


def quoted(name: str) -> str:
    """Feature names hold dots, which Spark reads as struct access unless quoted."""
    return f"`{name}`"


def feature_columns() -> list[Column]:
    los = length_of_stay_days(F.col("admission_date"), F.col("discharge_date"))
    return [
        F.col("age"),
        los.alias("length_of_stay_days"),
        *_one_hot("sex", F.col("sex"), SEX_VALUES),
        *_one_hot("dx", known_diagnosis(F.col("primary_diagnosis")), DIAGNOSIS_VALUES),
        *_one_hot("age_bucket", age_bucket(F.col("age")), AGE_BUCKETS),
    ]


def patients_to_features(
    patients: DataFrame, include_label: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns, then the features in contract order, then the label."""
    kept = [F.col(c) for c in keep]
    label = [F.col(LABEL)] if include_label else []
    return patients.select(*kept, *feature_columns(), *label)


def split_features_label(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        features.select(*map(quoted, feature_names())),
        features.select(F.col(LABEL).cast("int").alias(LABEL)),
    )


def require_features(columns: Sequence[str], expected: Sequence[str]) -> None:
    """Same names in the same order, or an error before any job starts."""
    if list(columns) != list(expected):
        raise ValueError(
            f"feature columns {list(columns)} do not match the model's "
            f"{list(expected)}; retrain the model"
        )


def _one_hot(prefix: str, value: Column, values: Sequence[str]) -> list[Column]:
    return [
        F.coalesce((value == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}")
        for v in values
    ]
