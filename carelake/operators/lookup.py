"""Joins to a lookup table whose keys are unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle

BROADCAST_BYTES = 256 * 1024 * 1024


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a frame whose measured content stays under ``limit`` bytes.

    A larger one is joined by a shuffle, where AQE splits the partitions of hot
    keys (``spark.sql.adaptive.skewJoin``).
    """
    content = F.octet_length(F.to_json(F.struct("*")))
    size = df.agg(F.coalesce(F.sum(content), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if size <= limit else df


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the lookup columns to each row; the lookup is computed once."""
    return rows.join(broadcast_if_small(settle(lookup), limit), on, how)
