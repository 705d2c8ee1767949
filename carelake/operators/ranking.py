"""Ranks and splits over whole tables without a single-task window.

Keys are ordered by their MD5 text, which is spread evenly. A count per digest
prefix (at most 65,536 per group, so always small enough to broadcast) tells
where each prefix starts; only rows within one prefix are ever sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle
from .lookup import broadcast_if_small

PREFIX_DIGITS = 4


def digest(key: str, seed: str = "") -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))


def _prefix(digest_column: str) -> Column:
    return F.substring(digest_column, 1, PREFIX_DIGITS)


def number_by_digest(
    df: DataFrame, key: str, name: str, start: int | Column = 1
) -> DataFrame:
    """Dense numbers from ``start`` in digest order of the unique column ``key``."""
    keyed = df.withColumn("_digest", digest(key)).withColumn("_prefix", _prefix("_digest"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy("_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_prefix").orderBy("_digest", key)
    return (
        keyed.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(starts), "_prefix")
        .withColumn(name, F.col("_before") + F.col("_rank") - 1 + F.lit(start))
        .select(name, *df.columns)
    )


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: exactly ``round(n * test_size)`` rows of each label.

    The test rows are the first ones in digest order of the unique column
    ``key``, found as one cut value per label, so the rows do not move.
    """
    narrow = df.select(
        F.col(label).alias("_label"), digest(key, str(seed)).alias("_digest")
    ).withColumn("_prefix", _prefix("_digest"))
    up_to = Window.partitionBy("_label").orderBy("_prefix")
    whole = Window.partitionBy("_label")
    edge = (
        narrow.groupBy("_label", "_prefix")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_label",
            "_prefix",
            "_n",
            F.sum("_n").over(up_to).alias("_upto"),
            F.round(F.sum("_n").over(whole) * F.lit(test_size)).cast("long").alias("_want"),
        )
        .filter(F.col("_want").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto")))
        .select(
            "_label", "_prefix", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_nth")
        )
    )
    in_edge = Window.partitionBy("_label").orderBy("_digest")
    cut = (
        narrow.join(F.broadcast(edge), ["_label", "_prefix"])
        .withColumn("_rank", F.row_number().over(in_edge))
        .filter(F.col("_rank") == F.col("_nth"))
        .select(F.col("_label").alias("_cut_label"), F.col("_digest").alias("_cut"))
    )
    return (
        df.join(F.broadcast(cut), F.col(label) == F.col("_cut_label"), "left")
        .withColumn(
            "is_test",
            F.coalesce(digest(key, str(seed)) <= F.col("_cut"), F.lit(False)),
        )
        .select(*df.columns, "is_test")
    )


def with_positions(rows: DataFrame, name: str = "position") -> DataFrame:
    """Dense positions, from 0, of rows read from files: by path, and by place within
    the file. Rows stay in their partitions: the only thing sorted is one row per file
    split. ``rows`` is a read of files, with no shuffle in between."""
    placed = settle(
        rows.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    # numbers run through the splits of a partition one after the other
    splits = placed.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    moved = splits.select("_file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_move"))
    met = placed.join(broadcast_if_small(settle(moved)), ["_file", "_start"])
    return met.withColumn(name, F.col("_row") + F.col("_move")).select(*rows.columns, name)
