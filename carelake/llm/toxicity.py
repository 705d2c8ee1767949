"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Texts are lower-cased, runs of white space become one space, and a space stands
at both ends. The distinct n-grams of 3 to 5 characters are hashed into buckets.
Each bucket has the log-count ratio r = log(P(bucket | toxic) / P(bucket | clean))
over all labelled training rows. A logistic regression is fitted on x * r, where
x is the logarithm of one plus a bucket's count in the text, over the buckets
that tell the labels apart most. Ratios and counts use every training row. The
fit uses a sample of about ``fit_rows`` of them at most, weighted back to the
shares of the labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..runtime import settle
from .common import BROADCAST_BYTES, in_tasks

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
LENGTHS = (3, 4, 5)
#: Buckets that the classifier weighs: those that tell the labels apart most.
FEATURES = 1 << 12
#: Training rows of the fit, half of each label, chosen by a hash of the doc_id.
#: One task fits them as a matrix of FIT_ROWS x FEATURES floats (131 MB).
FIT_ROWS = 8_000
SMOOTHING = 1.0
PENALTY = 3e-4
STEPS, RATE = 120, 0.02
PIECE = 1 << 20  # characters hashed at once


def held_out(doc_id: Column) -> Column:
    """Rows that never teach the classifier: crc32 of the id as text, modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hashed(
    text: str | None, lengths: tuple[int, ...] = LENGTHS, bits: int = BUCKET_BITS
) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, in turn; long texts piece by piece."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    overlap = max(lengths) - 1
    for at in range(0, len(plain), PIECE):
        part = plain[at : at + PIECE + overlap]
        points = np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32)
        for n in lengths:
            size = min(PIECE, len(points) - n + 1)
            if size < 1:
                continue
            mixed = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
            for i in range(n):
                mixed = (mixed ^ points[i : i + size]) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(13)
            yield (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)


def distinct_buckets(text: str | None, seen: np.ndarray) -> np.ndarray:
    """Sorted distinct buckets; ``seen`` is a scratch array of BUCKETS false
    values and is left so."""
    for some in hashed(text):
        seen[some] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def values_of(text: str | None, place: np.ndarray, size: int) -> np.ndarray:
    """log(1 + count) of each chosen bucket; ``place`` has its column, or -1."""
    counts = np.zeros(size, dtype=np.int64)
    for some in hashed(text):
        at = place[some]
        counts += np.bincount(at[at >= 0], minlength=size)
    return np.log1p(counts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each label that have a bucket, one partial row per bucket and task."""
    counts, seen = np.zeros((2, BUCKETS), dtype=np.int64), np.zeros(BUCKETS, dtype=bool)
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"].to_pylist()):
            counts[label][distinct_buckets(text.as_py(), seen)] += 1
    some = np.flatnonzero(counts.any(axis=0))
    columns = [pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "clean", "toxic"])


def _scaled(place: np.ndarray, ratio: np.ndarray) -> Callable:
    """Fit rows as columns and values of their features, each times its ratio."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, values = [], []
            for text in batch["text"]:
                value = values_of(text.as_py(), place, len(ratio))
                some = np.flatnonzero(value)
                columns.append(some)
                values.append((value * ratio)[some])
            arrays = [
                pa.array(columns, pa.list_(pa.int32())),
                pa.array(values, pa.list_(pa.float64())),
                batch["label"],
                batch["weight"],
                batch["key"],
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["column", "value", "label", "weight", "key"])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with a squared penalty: a fixed number of
    full-batch steps with adaptive moments, which scale badly scaled columns."""
    at = np.zeros(x.shape[1] + 1, dtype=np.float32)
    first, second = np.zeros_like(at), np.zeros_like(at)
    weight = (weight / weight.sum()).astype(np.float32)
    for step in range(1, STEPS + 1):
        margin = np.clip(x @ at[:-1] + at[-1], -60, 60)
        error = (weight * (1 / (1 + np.exp(-margin)) - y)).astype(np.float32)
        slope = np.append(error @ x + PENALTY * at[:-1], error.sum())
        first += (slope - first) / 10
        second += (slope * slope - second) / 100
        at -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return at[:-1].astype(np.float64), float(at[-1])


def _fitted(size: int, expected: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights = [], []
        # filled in place; memory is taken as rows are written
        x = np.zeros((expected + expected // 4 + 1000, size), dtype=np.float32)
        for batch in batches:
            at = len(labels)
            labels += batch["label"].to_pylist()
            weights += batch["weight"].to_pylist()
            if len(labels) > len(x):
                x = np.concatenate([x, np.zeros((len(labels), size), dtype=np.float32)])
            for i, (column, value) in enumerate(zip(batch["column"], batch["value"]), at):
                x[i, column.values.to_numpy()] = value.values.to_numpy()
        if labels:
            coefficients, intercept = fit_logistic(x[: len(labels)], np.array(labels), np.array(weights))
            yield pa.RecordBatch.from_arrays(
                [pa.array([coefficients], pa.list_(pa.float64())), pa.array([intercept])],
                ["coefficients", "intercept"],
            )

    return run


@dataclass
class Classifier:
    """Column of each bucket (or -1), weight of each column (its ratio times its
    coefficient) and an intercept."""

    place: np.ndarray
    weights: np.ndarray
    intercept: float

    def score_text(self, text: str | None) -> float:
        margin = float(values_of(text, self.place, len(self.weights)) @ self.weights) + self.intercept
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def train(texts: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES) -> Classifier:
    """Learn from ``texts`` (key long, text string, label int 0 or 1).

    Nulls in text count as empty; rows with a null label must be gone. Without
    rows of both labels the score is the smoothed share of toxic rows.
    """
    rows = texts.groupBy("label").count().collect()  # two rows
    n = np.array([next((r["count"] for r in rows if r["label"] == label), 0) for label in (0, 1)])
    if not n.all():
        share = (n[1] + 1) / (n.sum() + 2)
        return Classifier(np.full(BUCKETS, -1, np.int32), np.zeros(1), float(np.log(share / (1 - share))))
    counted = in_tasks(texts.select("text", "label"), _count, "bucket long, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = counted.toPandas()  # a row per bucket at most
    counts = np.zeros((2, BUCKETS))
    counts[0][found["bucket"]] = found["clean"]
    counts[1][found["bucket"]] = found["toxic"]
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    ratios = np.log(shares[1] / shares[0])
    apart = np.abs(counts[1] / n[1] - counts[0] / n[0])
    chosen = np.sort(np.argsort(-apart, kind="stable")[:features])
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    ratio = ratios[chosen]

    shares = [min(1.0, fit_rows / 2 / n[label]) for label in (0, 1)]
    share = F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    # by row, not by key: the rows of a key that many rows share are drawn apart
    drawn = F.pmod(F.xxhash64("key", F.monotonically_increasing_id()), F.lit(1_000_003)) < share * 1_000_003
    weight = F.when(F.col("label") == 1, 1 / shares[1]).otherwise(1 / shares[0])
    sample = in_tasks(
        texts.where(drawn).select("text", "label", weight.alias("weight"), "key"),
        _scaled(place, ratio),
        "column array<int>, value array<double>, label int, weight double, key long",
    )
    ordered = sample.repartition(1).sortWithinPartitions("key")
    fit = in_tasks(ordered, _fitted(len(chosen), int(min(fit_rows, n.sum()))), "coefficients array<double>, intercept double").first()
    return Classifier(place, ratio * np.array(fit["coefficients"]), fit["intercept"])


def _scores(model: Classifier) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score_text(text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return run


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows (key, text, label): labelled rows outside the held-out fifth.

    A doc_id with several labels counts as toxic if one of them says so; other
    labels than 0 and 1 are ignored. Labels are broadcast if they measure small,
    so that texts needn't be shuffled.
    """
    marks = labels.select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("label"))
    marks = marks.where("key is not null and label in (0, 1)").where(~held_out(F.col("key")))
    marks = settle(marks.groupBy("key").agg(F.max("label").alias("label")))
    texts = docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"))
    return texts.join(broadcast_if_small(marks, BROADCAST_BYTES), "key")


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; null texts are empty."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = in_tasks(rows, _scores(model), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text scores below one half. A classifier
    that had no label of one kind tells no texts apart and rejects none."""
    if not model.weights.any():
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [model.score_text(text.as_py()) < 0.5 for text in batch["text"]]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return in_tasks(docs, run, docs.schema)


def crc_remainder(doc_id: int) -> int:
    """The remainder that decides ``held_out``, for checks outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 5
