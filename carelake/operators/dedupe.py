"""One row per key.

``row_number() == 1`` plans as a group limit below the exchange, so every map
task sends at most one row per key and a hot key costs no more than a cold one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def keep_latest(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str]
) -> DataFrame:
    """Latest row per key; the other columns break ties so that reruns agree."""
    rest = sorted(c for c in df.columns if c not in {*keys, *latest})
    return keep_first(df, keys, [F.col(f"`{c}`").desc() for c in (*latest, *rest)])


def first_query_wins(
    found: DataFrame, ordinal: str = "query_no", position: str = "position"
) -> DataFrame:
    """An abstract found by several searches stays with the first of them."""
    rest = sorted(c for c in found.columns if c not in {"pmid", ordinal, position})
    return keep_first(
        found,
        ["pmid"],
        [F.col(ordinal).asc_nulls_last(), F.col(position).asc_nulls_last(), *map(F.col, rest)],
    )
