"""Binary classification metrics over any number of scores.

Rows are first added up per distinct score. Distinct scores are then cut into
ranges by sampled boundaries, so the running totals of a curve are computed per
range, on top of the totals of the ranges above it. Rows whose score is null or
NaN, or whose label is null, have no place on a curve and are left out.
"""

from __future__ import annotations

from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle

RANGES = 1024


def binary_metrics(
    scored: DataFrame, score: str, label: str, threshold: float = 0.5
) -> DataFrame:
    """One row: n, n_positive, auc, precision, recall, average_precision.

    n counts the rows that have both a score and a label. AUC is null when a class is missing; the other metrics are 0 then.
    """
    positive = F.col(label).cast("boolean")
    known = scored.select(
        F.col(score).cast("double").alias("score"), positive.alias("positive")
    ).where("score is not null and not isnan(score) and positive is not null")
    positive = F.col("positive")
    per_score = settle(
        known.groupBy("score").agg(
            F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
        )
    )
    curve = _with_totals_above(per_score)
    hit = F.col("score") >= threshold
    sums = curve.agg(
        _sum("pos").alias("p"),
        _sum("neg").alias("n"),
        _sum(F.when(hit, F.col("pos"))).alias("tp"),
        _sum(F.when(hit, F.col("neg"))).alias("fp"),
        _sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2)).alias("pairs_won"),
        _sum(
            F.col("pos")
            * (F.col("pos_above") + F.col("pos"))
            / (F.col("pos_above") + F.col("pos") + F.col("neg_above") + F.col("neg"))
        ).alias("steps"),
    )
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    return sums.select(
        (F.col("p") + F.col("n")).cast("long").alias("n"),
        F.col("p").cast("long").alias("n_positive"),
        F.try_divide("pairs_won", F.col("p") * F.col("n")).alias("auc"),
        share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        share(F.col("tp"), F.col("p")).alias("recall"),
        share(F.col("steps"), F.col("p")).alias("average_precision"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (2 * n_class) for each class, two rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    n = F.sum("n_class").over(Window.partitionBy())
    return counts.withColumn("class_weight", n / (2 * F.col("n_class")))


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("positive_rate"))


def _sum(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.sum(value.cast("double")), F.lit(0.0))


def _with_totals_above(per_score: DataFrame) -> DataFrame:
    """Adds the positives and negatives at strictly higher scores."""
    shares = [i / RANGES for i in range(1, RANGES)]
    sampled = per_score.approxQuantile("score", shares, 1 / (2 * RANGES))
    bounds = sorted({b for b in sampled if isfinite(b)}) or [0.0]
    ranged = Bucketizer(
        splits=[float("-inf"), *bounds, float("inf")], inputCol="score", outputCol="range"
    ).transform(per_score)
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .select(
            "range",
            _total_above("pos", "range").alias("pos_offset"),
            _total_above("neg", "range").alias("neg_offset"),
        )
    )
    within = {
        f"{c}_within": _total_above(c, "score", Window.partitionBy("range"))
        for c in ("pos", "neg")
    }
    return (
        ranged.withColumns(within)
        .join(F.broadcast(offsets), "range")
        .withColumn("pos_above", F.col("pos_offset") + F.col("pos_within"))
        .withColumn("neg_above", F.col("neg_offset") + F.col("neg_within"))
    )


def _total_above(count: str, order: str, window=Window) -> Column:
    """Running total over the rows before this one in descending order."""
    above = window.orderBy(F.col(order).desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return F.coalesce(F.sum(count).over(above), F.lit(0))
