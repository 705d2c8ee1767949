import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.fixed_values import LABEL
from carelake.operators.features import feature_names, patients_to_features
from carelake.operators.forest import load_model, predict_proba, train_model
from carelake.operators.forest_rows import (
    importance_by_name,
    importances,
    read_nodes,
    rule_nodes,
    scores,
    walk,
    with_stats,
)
from carelake.operators.metrics import class_weights
from carelake.operators.shap import Explainer
from carelake.plans import scoring
from carelake.schemas import PATIENT_SCHEMA

RULES = [
    (0, 0, 1, 2, "b", 0.5),
    (0, 1, 3, 4, "a", 4.0),
    (0, 2, -1, -1, None, None),
    (0, 3, -1, -1, None, None),
    (0, 4, 5, 6, "a", 7.0),
    (0, 5, -1, -1, None, None),
    (0, 6, -1, -1, None, None),
    (1, 0, -1, -1, None, None),
]


def leaf(tree, a, b):
    if tree == 1:
        return 0
    if b > 0.5:
        return 2
    return 3 if a <= 4 else 5 if a <= 7 else 6


@pytest.fixture
def rows(spark):
    rng = np.random.default_rng(1)
    made = [([float(rng.integers(0, 10)), float(rng.integers(0, 2))], bool(rng.random() < 0.3), i) for i in range(500)]
    made += [([9.0, 0.0], True, 500 + i) for i in range(250)]  # a third are one vector
    return made


def test_walk_ends_at_the_leaf_of_every_tree(spark, rows):
    nodes = rule_nodes(spark, RULES, ["a", "b"])
    vectors = spark.createDataFrame([(i, v) for v, _, i in rows], "key long, values array<double>")
    got = {(r.key, r.tree): r.node for r in walk(vectors, nodes).collect()}
    assert got == {(i, t): leaf(t, *v) for v, _, i in rows for t in (0, 1)}
    assert walk(vectors.limit(0), nodes).count() == 0


def test_stats_scores_and_importances(spark, rows):
    table = spark.createDataFrame([(v, y) for v, y, _ in rows] + [([1.0, 1.0], None)], "values array<double>, y boolean")
    weights = class_weights(table.where("y is not null"), "y")
    weight = {r.y: r.class_weight for r in weights.collect()}
    nodes = with_stats(rule_nodes(spark, RULES, ["a", "b"]), table, weights, "y")
    passed = {0: [0], 2: [0, 2], 3: [0, 1, 3], 5: [0, 1, 4, 5], 6: [0, 1, 4, 6]}
    want = {(t, n): [0.0, 0.0] for t, n, *_ in RULES}
    for v, y, _ in rows:
        for t in (0, 1):
            for n in passed[leaf(t, *v)]:
                want[t, n][y] += weight[y]
    got = {(r.tree, r.node): r.stats for r in nodes.collect()}
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)

    vectors = spark.createDataFrame([(i, v) for v, _, i in rows], "key long, values array<double>")
    share = lambda s: s[1] / sum(s)
    for r in scores(vectors, nodes, "key").collect():
        v = rows[r.key][0]
        assert r.probability == pytest.approx(np.mean([share(want[t, leaf(t, *v)]) for t in (0, 1)]))

    gini = lambda s: sum(s) * 2 * share(s) * (1 - share(s))
    gain = {0: 0.0, 1: 0.0}
    for t, n, left, right, name, _ in RULES:
        if name:
            gain["ab".index(name)] += gini(want[t, n]) - gini(want[t, left]) - gini(want[t, right])
    total = sum(gain.values())
    assert {r.feature: pytest.approx(r.importance) for r in importances(nodes).collect()} == {f: g / total for f, g in gain.items()}


@pytest.fixture(scope="module")
def deep(spark, tmp_path_factory):
    """A forest of deep trees over patients whose label follows no rule."""
    import datetime as dt

    rng = np.random.default_rng(7)
    day = dt.date(2024, 1, 1)
    rows = [
        (f"P{i}", int(rng.integers(0, 100)), "FMO"[i % 3], day, day + dt.timedelta(days=int(rng.integers(0, 30))), None, bool(rng.random() < 0.5))
        for i in range(600)
    ]
    patients = spark.createDataFrame(rows, PATIENT_SCHEMA).cache()
    path = str(tmp_path_factory.mktemp("deep") / "forest")
    return patients, train_model(patients, path, n_estimators=7)


def test_rows_of_a_saved_model_score_like_it(spark, deep):
    patients, result = deep
    nodes = read_nodes(spark, result.model_path)
    model = load_model(spark, result.model_path)
    features = patients_to_features(patients, False, keep=["mrn"])
    want = {r.mrn: r.probability for r in predict_proba(features, model, ["mrn"]).collect()}
    got = scoring.predict_by_rows(patients.drop(LABEL), nodes)[0].collect()
    assert {r.mrn: pytest.approx(r.readmission_probability) for r in got} == want
    by_rows = importance_by_name(nodes, feature_names())
    assert by_rows == {n: pytest.approx(v, abs=1e-9) for n, v in result.feature_importance.items()}


def test_deep_trees_are_explained_in_parts(spark, deep, monkeypatch):
    from carelake.operators import shap

    patients, result = deep
    whole = Explainer(spark, result.model_path)
    monkeypatch.setattr(shap, "ROWS_PER_BLOCK", 100)
    monkeypatch.setattr(shap, "NODES_PER_GROUP", 300)
    one = scoring.explain(patients.drop(LABEL).limit(120), whole)[0]
    for r in one.collect():
        total = sum(c.shap_value for c in r.contributions)
        assert total == pytest.approx(r.predicted_probability - r.baseline_probability, abs=1e-9)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan or "Checkpoint" in plan or "ExistingRDD" in plan


def test_empty_nodes_are_refused(spark):
    nodes = rule_nodes(spark, RULES, ["a", "b"]).withColumn(
        "stats", F.when(F.col("node") == 6, F.array(F.lit(0.0), F.lit(0.0))).otherwise(F.array(F.lit(1.0), F.lit(1.0)))
    )
    with pytest.raises(ValueError, match="no training weight"):
        Explainer(spark, nodes=nodes)
