"""A forest as a table: one row per node, walked by joins.

Columns: tree, node, left, right (node numbers, -1 at a leaf), feature (its place in
the feature list), threshold (a value at most this goes left) and stats, the training
weight of label 0 and of label 1 at the node. A saved model is read into such rows,
and rules written by hand get their stats from patients.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import settle
from ..sources.tables import table_exists
from .lookup import attach, broadcast_if_small

NODE_SCHEMA = "tree int, node int, left int, right int, feature int, threshold double"
ROOT = 0
#: Joins between two checkpoints of a walk.
LEVELS_PER_STEP = 6


def read_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """The nodes of a saved model, read from its files by the tasks that use them."""
    if not table_exists(spark, str(model_path)):
        raise FileNotFoundError(f"no model at {model_path}; train one first")
    node = F.col("nodeData")
    return spark.read.parquet(f"{model_path}/stages/*RandomForestClassifier*/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["impurityStats"].alias("stats"),
    )


def rule_nodes(
    spark: SparkSession, rules: Sequence[tuple[int, int, int, int, str | None, float | None]], features: Sequence[str]
) -> DataFrame:
    """Node rows without stats, from (tree, node, left, right, feature name, threshold)."""
    rows = [
        (tree, node, left, right, features.index(name) if name else -1, threshold)
        for tree, node, left, right, name, threshold in rules
    ]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def tree_numbers(nodes: DataFrame) -> list[int]:
    """One number per tree."""
    return [r.tree for r in nodes.where(F.col("node") == ROOT).select("tree").orderBy("tree").collect()]


def _started(vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    trees = F.array(*map(F.lit, tree_numbers(nodes)))
    return vectors.withColumns({"tree": F.explode(trees), "node": F.lit(ROOT)})


def _stepped(at: DataFrame, nodes: DataFrame) -> DataFrame:
    """One level down: rows at a leaf stay, the others move to a child."""
    goes_left = F.get("values", F.col("feature")) <= F.col("threshold")
    child = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
    met = at.join(nodes, ["tree", "node"])
    return met.withColumn("node", F.when(F.col("left") < 0, F.col("node")).otherwise(child)).select(*at.columns)


def _splits(nodes: DataFrame) -> DataFrame:
    return broadcast_if_small(settle(nodes.select("tree", "node", "left", "right", "feature", "threshold")))


def walk(vectors: DataFrame, nodes: DataFrame) -> DataFrame:
    """The leaf of every row in every tree: the columns of ``vectors``, tree, node.

    ``vectors`` has the feature ``values`` as an array in the model's order, and
    names of its own for further columns. Rows of all trees step down a level per
    join; node rows are broadcast if they measure small, else the join shuffles and
    AQE splits the rows that stand at one node.
    """
    splits = _splits(nodes)
    at = _started(vectors, nodes)
    inner = splits.where("left >= 0").select("tree", "node")
    while True:
        for _ in range(LEVELS_PER_STEP):
            at = _stepped(at, splits)
        at = settle(at)
        if at.join(inner, ["tree", "node"], "left_semi").isEmpty():
            return at


def positive_share(stats: Column) -> Column:
    return stats[1] / (stats[0] + stats[1])


def scores(vectors: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """``key`` (unique in ``vectors``) and ``probability``, the mean over the trees of
    the positive share at the leaf."""
    share = nodes.select("tree", "node", positive_share(F.col("stats")).alias("share"))
    leaf = walk(vectors.select(key, "values"), nodes).join(broadcast_if_small(share), ["tree", "node"])
    return leaf.groupBy(key).agg(F.avg("share").alias("probability"))


def score_features(features: DataFrame, nodes: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``probability`` for each row of a feature table; each distinct
    vector walks once."""
    values = F.array(*[F.col(f"`{n}`").cast("double") for n in names])
    rows = features.select(*keep, values.alias("values"))
    distinct = settle(rows.select("values").distinct().withColumn("_vector", F.monotonically_increasing_id()))
    known = distinct.join(scores(distinct, nodes, "_vector"), "_vector").select("values", "probability")
    return attach(rows, known, "values").select(*keep, "probability")


def with_stats(nodes: DataFrame, rows: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    """Node rows with the weight of the ``rows`` (values, label) that pass each node.

    ``weights`` (label, class_weight) has the weight of each label. Equal vectors are
    counted first and walk once. Rows without label are left out.
    """
    counted = rows.where(F.col(label).isNotNull()).groupBy("values", F.col(label).cast("int").alias("label"))
    counted = settle(counted.agg(F.count(F.lit(1)).alias("n")))
    splits = _splits(nodes)
    inner = splits.where("left >= 0").select("tree", "node")
    at, passed = _started(counted, nodes), []
    while True:
        here = at.groupBy("tree", "node", "label").agg(F.sum("n").alias("n"))
        passed.append(settle(here))
        at = at.join(inner, ["tree", "node"], "left_semi")
        if at.isEmpty():
            break
        at = settle(_stepped(at, splits))
    total = passed[0]
    for more in passed[1:]:
        total = total.unionByName(more)
    weight = weights.select(F.col(label).cast("int").alias("label"), "class_weight")
    weighed = total.join(F.broadcast(weight), "label").groupBy("tree", "node").agg(
        *[F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n") * F.col("class_weight"))), F.lit(0.0)).alias(f"w{c}") for c in (0, 1)]
    )
    stats = F.array(F.coalesce("w0", F.lit(0.0)), F.coalesce("w1", F.lit(0.0)))
    return nodes.join(weighed, ["tree", "node"], "left").select(*nodes.columns, stats.alias("stats"))


def importances(nodes: DataFrame) -> DataFrame:
    """(feature, importance) of every feature that a tree tests, in sum 1: the weight
    times the fall of Gini impurity at its nodes, each tree scaled to 1 first."""
    weight = F.col("stats")[0] + F.col("stats")[1]
    share = F.try_divide(F.col("stats")[1], weight)
    # weight times impurity, so that a split's gain is a plain difference
    own = nodes.select("*", weight.alias("weight"), F.coalesce(2 * share * (1 - share) * weight, F.lit(0.0)).alias("impure"))
    kids = own.select("tree", F.col("node").alias("kid"), F.col("impure").alias("kid_impure"))
    inner = own.where("left >= 0").select("tree", "node", "feature", "impure", F.explode(F.array("left", "right")).alias("kid"))
    below = inner.join(kids, ["tree", "kid"]).groupBy("tree", "node", "feature", "impure").agg(F.sum("kid_impure").alias("below"))
    per_tree = below.groupBy("tree", "feature").agg(F.sum(F.col("impure") - F.col("below")).alias("gain"))
    whole = per_tree.groupBy("tree").agg(F.sum("gain").alias("whole"))
    scaled = per_tree.join(F.broadcast(whole), "tree").where("whole > 0")  # a row per tree
    summed = scaled.groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("gain"))
    total = summed.agg(F.sum("gain").alias("total"))
    return summed.select("feature", (F.col("gain") / total.scalar()).alias("importance"))


def importance_by_name(nodes: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """Importance of every feature; those that no tree tests have none."""
    found = {r.feature: r.importance for r in importances(nodes).collect()}  # a row per feature
    return {name: found.get(i, 0.0) for i, name in enumerate(names)}
