"""Additive per-feature contributions of a random forest's scores.

Path-dependent TreeSHAP after Lundberg et al. (2020), in the polynomial form of
Yu et al. (2022): along a path, a feature that holds the share ``z`` of the
training weight and that the row satisfies (``o`` = 1) or not (``o`` = 0) stands
for the factor ``o * t + z * (1 - t)``. The Shapley value is an integral over
``t`` of products of these factors, which Gauss-Legendre points give exactly.

The work per row depends on its feature values only, so each distinct feature
vector is explained once and joined back to its patients.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import settle, ship_package
from .features import feature_names, quoted, require_features
from .forest import load_model, model_features
from .forest_rows import ROOT, positive_share, read_nodes

#: Rows that a node takes as they are, without a look for equal ones.
FEW_ROWS = 32
#: Distinct vectors in a block, and node rows in a group of more than one tree.
ROWS_PER_BLOCK = 32_768
NODES_PER_GROUP = 100_000


@dataclass(frozen=True)
class Tree:
    """Flat node arrays; ``left`` is -1 at a leaf."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    def features_on_a_path(self, node: int = 0, seen: frozenset = frozenset()) -> int:
        """The most distinct features that any path from root to leaf tests."""
        if self.left[node] < 0:
            return len(seen)
        seen = seen | {int(self.feature[node])}
        return max(
            self.features_on_a_path(self.left[node], seen),
            self.features_on_a_path(self.right[node], seen),
        )


def trees_of(nodes: pd.DataFrame) -> list[Tree]:
    """Flat trees from node rows."""
    trees = []
    for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
        stats = np.stack(part["stats"].to_numpy())
        # the rows of a tree by place: node numbers may have gaps
        place = pd.Series(np.arange(len(part)), index=part["node"].to_numpy())
        cover = stats.sum(axis=1)
        trees.append(
            Tree(
                left=part["left"].map(place).fillna(-1).to_numpy(dtype="int64"),
                right=part["right"].map(place).fillna(-1).to_numpy(dtype="int64"),
                feature=part["feature"].to_numpy(),
                threshold=part["threshold"].to_numpy(dtype="float64"),
                cover=cover,
                value=stats[:, 1] / cover,
            )
        )
    return trees


def baseline(trees: list[Tree]) -> float:
    """Score expected when nothing is known of the row."""
    return float(np.mean([t.value[0] for t in trees]))


class _Tests:
    """The tests of a tree, numbered by feature and threshold, and those below each node."""

    def __init__(self, tree: Tree):
        # nodes in the order of a walk: those below a node follow it without a gap
        order, self.place, self.end = [], np.zeros(len(tree.left), "int64"), np.zeros(len(tree.left), "int64")
        stack = [(0, False)]
        while stack:
            node, done = stack.pop()
            if done:
                self.end[node] = len(order)
                continue
            self.place[node] = len(order)
            order.append(node)
            stack.append((node, True))
            if tree.left[node] >= 0:
                stack += [(int(tree.right[node]), False), (int(tree.left[node]), False)]
        order = np.array(order)
        inner = order[tree.left[order] >= 0]
        known = np.unique(np.stack([tree.feature[inner].astype("float64"), tree.threshold[inner]], axis=1), axis=0)
        self.feature = known[:, 0].astype("int64")
        self.threshold = known[:, 1]
        self.first = {int(f): int(np.searchsorted(self.feature, f)) for f in np.unique(self.feature)}
        number = np.full(len(tree.left), -1, dtype="int64")
        for node in inner:
            first, stop = self._range(int(tree.feature[node]))
            number[node] = first + np.searchsorted(self.threshold[first:stop], tree.threshold[node])
        self.number = number
        self._walked = number[order]

    def _range(self, feature: int) -> tuple[int, int]:
        first = self.first[feature]
        return first, int(np.searchsorted(self.feature, feature, side="right"))

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """For each value the first test of its feature that it passes (goes left at)."""
        codes = np.zeros(rows.shape, dtype="int64")
        for feature in self.first:
            first, stop = self._range(feature)
            codes[:, feature] = first + np.searchsorted(self.threshold[first:stop], rows[:, feature])
        return codes

    def below(self, node: int) -> list[tuple[int, np.ndarray]]:
        """The distinct tests at a node and below it, by feature."""
        used = np.unique(self._walked[self.place[node] : self.end[node]])
        used = used[used >= 0]
        features = self.feature[used]
        cuts = np.flatnonzero(np.diff(features)) + 1
        return [(int(self.feature[part[0]]), part) for part in np.split(used, cuts)]


def _apart(key: np.ndarray, size: int, code: np.ndarray, n_codes: int) -> tuple[np.ndarray, int]:
    """``key`` (below ``size``) extended by a code, renumbered before it outgrows 64 bits."""
    if size * n_codes > 1 << 62:
        key = np.unique(key, return_inverse=True)[1]
        size = len(key)
    return key * n_codes + code, size * n_codes


def tree_contributions(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """Contributions of one tree, same shape as ``rows``.

    Rows that passed the same tests on the way to a node and that no test below it tells
    apart are equal there: they go down as one. So a node costs as many rows as its own
    branch distinguishes, and not all of them.
    """
    points, weights = np.polynomial.legendre.leggauss(
        tree.features_on_a_path() // 2 + 1
    )
    t, w = (points + 1) / 2, weights / 2
    tests = _Tests(tree)
    width = rows.shape[1]

    def descend(node: int, codes: np.ndarray, product: np.ndarray, seen: dict):
        """Sum over the leaves below, and contributions of the edges below, per row."""
        if tree.left[node] < 0:
            return product * tree.value[node], None
        if len(codes) <= FEW_ROWS:
            return split(node, codes, product, seen)
        key, size = np.zeros(len(codes), dtype="int64"), 1
        for met, _ in seen.values():
            key, size = _apart(key, size, met.astype("int64"), 2)
        for j, known in tests.below(node):
            key, size = _apart(key, size, np.searchsorted(known, codes[:, j]), len(known) + 1)
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        if 4 * len(first) > 3 * len(codes):
            return split(node, codes, product, seen)
        met_once = {j: (met[first], share) for j, (met, share) in seen.items()}
        total, out = split(node, codes[first], product[first], met_once)
        return total[of], out[of]

    def split(node: int, codes: np.ndarray, product: np.ndarray, seen: dict):
        j = int(tree.feature[node])
        met, share = seen[j] if j in seen else (np.ones(len(codes)), 1.0)
        factor = met[:, None] * t + share * (1 - t)
        without = product / factor
        lost = (met - share)[:, None] / factor
        out = np.zeros((len(codes), width))
        below = 0.0
        goes_left = codes[:, j] <= tests.number[node]
        for child, taken in (
            (tree.left[node], goes_left),
            (tree.right[node], ~goes_left),
        ):
            met_child = met * taken
            share_child = share * tree.cover[child] / tree.cover[node]
            factor_child = met_child[:, None] * t + share_child * (1 - t)
            total, deeper = descend(
                child, codes, without * factor_child, {**seen, j: (met_child, share_child)}
            )
            if deeper is not None:
                out += deeper
            gain = (met_child - share_child)[:, None] / factor_child - lost
            out[:, j] += (total * gain) @ w
            below = below + total
        return below, out

    out = descend(0, tests.codes(rows), np.ones((len(rows), len(t))), {})[1]
    return np.zeros(rows.shape) if out is None else out


def tree_scores(tree: Tree, rows: np.ndarray) -> np.ndarray:
    """Value of the leaf that each row reaches."""
    at = np.zeros(len(rows), dtype="int64")
    while True:
        inner = np.nonzero(tree.left[at] >= 0)[0]
        if not len(inner):
            return tree.value[at]
        node = at[inner]
        goes_left = rows[inner, tree.feature[node]] <= tree.threshold[node]
        at[inner] = np.where(goes_left, tree.left[node], tree.right[node])


def forest_contributions(trees: list[Tree], rows: np.ndarray) -> np.ndarray:
    return np.mean([tree_contributions(tree, rows) for tree in trees], axis=0)


class Explainer:
    """Explains by the node rows of a forest; they stay a table.

    The work is dealt as (group of trees, block of distinct vectors): a task gets the
    node rows of its trees and the vectors of its block, and passes on the sums over
    its trees, which are added up per vector by a partial aggregate.
    """

    def __init__(
        self, spark: SparkSession, model_path: str | None = None, nodes: DataFrame | None = None
    ):
        """Of a saved model, or of ``nodes`` (see ``forest_rows``) over the feature list."""
        ship_package(spark)
        if nodes is None:
            self.features = model_features(load_model(spark, model_path))
            require_features(feature_names(), self.features)
            nodes = read_nodes(spark, model_path)
        else:
            self.features = feature_names()
        self.nodes = nodes
        root = F.when(F.col("node") == ROOT, positive_share(F.col("stats")))
        found = nodes.agg(
            F.avg(root).alias("baseline"),
            F.count(root).alias("trees"),
            F.count(F.lit(1)).alias("nodes"),
            F.count_if(F.col("stats")[0] + F.col("stats")[1] <= 0).alias("empty"),
        ).first()
        if found.empty:
            raise ValueError(f"{found.empty} nodes have no training weight; prune them first")
        #: Score expected when nothing is known of the row.
        self.baseline: float = found.baseline
        self.n_trees: int = found.trees
        self._n_nodes: int = found.nodes

    def values_column(self) -> Column:
        """A row's feature values in order, the key of its explanation."""
        return F.array(*[F.col(quoted(n)).cast("double") for n in self.features])

    def explain_features(self, features: DataFrame) -> DataFrame:
        """One row per distinct feature vector: values, probability, shap."""
        spark = features.sparkSession
        distinct = features.select(self.values_column().alias("values")).distinct()
        vectors = settle(distinct.withColumn("vector", F.monotonically_increasing_id()))
        tasks = max(
            int(spark.conf.get("spark.sql.shuffle.partitions")),
            spark.sparkContext.defaultParallelism,
        )
        blocks = max(1, ceil(vectors.count() / ROWS_PER_BLOCK))
        # few vectors: more groups of trees; large trees: groups of bounded size
        groups = max(ceil(tasks / blocks), ceil(self._n_nodes / NODES_PER_GROUP))
        groups = max(1, min(groups, self.n_trees))
        group = F.pmod(F.col("tree"), F.lit(groups))
        block = F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")
        dealt_trees = self.nodes.withColumns(
            {"group": group, "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))}
        )
        dealt_rows = vectors.withColumns(
            {"block": block, "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))}
        )
        parts = [f"c{i}" for i in range(len(self.features))]

        def explained(nodes: pa.Table, rows: pa.Table) -> pa.Table:
            trees = trees_of(nodes.to_pandas()) if len(nodes) else []
            values = np.array(rows["values"].to_pylist(), dtype="float64").reshape(len(rows), len(parts))
            shap = np.zeros(values.shape)
            score = np.zeros(len(rows))
            for tree in trees:
                score += tree_scores(tree, values)
                shap += tree_contributions(tree, values)
            columns = {"vector": rows["vector"], "score": pa.array(score)}
            return pa.table(columns | {name: pa.array(shap[:, i]) for i, name in enumerate(parts)})

        summed = (
            dealt_trees.repartition(tasks, "group", "block")
            .groupBy("group", "block")
            .cogroup(dealt_rows.repartition(tasks, "group", "block").groupBy("group", "block"))
            .applyInArrow(explained, "vector long, score double, " + ", ".join(f"{p} double" for p in parts))
            .groupBy("vector")
            .agg(*[F.sum(c).alias(c) for c in ("score", *parts)])
        )
        n = F.lit(float(self.n_trees))
        means = summed.select(
            "vector",
            (F.col("score") / n).alias("probability"),
            F.array(*[F.col(p) / n for p in parts]).alias("shap"),
        )
        return vectors.join(means, "vector").select("values", "probability", "shap")

    def contributions_column(self) -> Column:
        """Array of (feature_name, feature_value, shap_value) in feature order."""
        return F.array(
            *[
                F.struct(
                    F.lit(name).alias("feature_name"),
                    F.col("values")[i].alias("feature_value"),
                    F.col("shap")[i].alias("shap_value"),
                )
                for i, name in enumerate(self.features)
            ]
        )
