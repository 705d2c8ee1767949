"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from .common import in_tasks


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the given edges and the smallest node each of them reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        hooked = label.copy()
        np.minimum.at(hooked, label[x], low)
        np.minimum.at(hooked, label[y], low)
        while (hooked != hooked[hooked]).any():
            hooked = hooked[hooked]
        if (hooked == label).all():
            return nodes, nodes[label]
        label = hooked


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            nodes, low = local_stars(batch["a"].to_numpy(), batch["b"].to_numpy())
            away = nodes != low
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[away]), pa.array(low[away])], ["a", "b"]
            )


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a") % 65_521)).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long): component
    is the smallest node that it reaches. No edges: no rows. Loops and repeated
    edges are allowed, nulls are not edges.

    Every round joins edges to the smallest neighbour of a node, found by a
    partial aggregate. A hub is a hot key of that join, which AQE splits. The
    rounds' results are checkpointed, so that a lost executor costs its tasks.
    """
    edges = edges.select("a", "b").where("a is not null and b is not null and a != b")
    edges = in_tasks(edges, _contract, "a long, b long")
    edges = settle(edges.distinct())
    seen = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(small.union(low.select("a", F.col("m").alias("b"))).where("a != b").distinct())
        now = _state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
