"""Ranking and filtering of an array of (feature_name, feature_value, shap_value)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def top_contributions(contributions: Column, n: int = 5) -> Column:
    """The ``n`` largest by absolute value; equal ones keep their feature order."""
    ranked = F.array_sort(
        F.transform(
            contributions,
            lambda c, i: F.struct(
                (-F.abs(c["shap_value"])).alias("rank"), i.alias("i"), c.alias("c")
            ),
        )
    )
    return F.transform(F.slice(ranked, 1, n), lambda r: r["c"])


def positive_contributions(contributions: Column) -> Column:
    return F.filter(contributions, lambda c: c["shap_value"] > 0)


def negative_contributions(contributions: Column) -> Column:
    return F.filter(contributions, lambda c: c["shap_value"] < 0)
