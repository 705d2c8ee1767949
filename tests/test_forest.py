import datetime as dt
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.fixed_values import LABEL
from carelake.functions.contributions import (
    negative_contributions,
    positive_contributions,
    top_contributions,
)
from carelake.operators.features import feature_names, patients_to_features
from carelake.operators.forest import (
    RandomForestClassifier,
    drawn_vectors,
    load_model,
    model_features,
    poisson_draws,
    predict_label,
    predict_proba,
    top_importances,
    train_model,
)
from carelake.operators.shap import Explainer, Tree, baseline, forest_contributions, tree_contributions
from carelake.plans import scoring
from carelake.schemas import PATIENT_SCHEMA

CODES = ["I50.9", "J44.9", "Z51.5", "E11.9", None]


def row(mrn, age, sex, start, end, dx, label=False):
    return (mrn, age, sex, dt.date.fromisoformat(start), dt.date.fromisoformat(end), dx, label)


HIGH = row("HIGH", 91, "F", "2023-03-04", "2023-03-23", "I50.9")
LOW = row("LOW", 27, "M", "2023-09-10", "2023-09-11", "Z51.5")


@pytest.fixture(scope="module")
def cohort(spark):
    """Old heart-failure patients with long stays come back, young ones do not."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        age, days, dx = int(rng.integers(20, 95)), int(rng.integers(0, 20)), CODES[i % 5]
        risk = 0.05 + 0.4 * (age > 65) + 0.2 * (days > 9) + 0.2 * (dx == "I50.9")
        end = (dt.date(2024, 1, 1) + dt.timedelta(days=days)).isoformat()
        rows.append(row(f"P{i}", age, "FMO"[i % 3], "2024-01-01", end, dx, bool(rng.random() < risk)))
    return spark.createDataFrame(rows, PATIENT_SCHEMA).cache()


@pytest.fixture(scope="module")
def result(cohort, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model") / "forest")
    return train_model(cohort, path, n_estimators=15, max_depth=5)


@pytest.fixture(scope="module")
def explainer(spark, result):
    return Explainer(spark, result.model_path)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), PATIENT_SCHEMA).drop(LABEL)


def test_training_result(cohort, result):
    assert result.n_train + result.n_test == cohort.count()
    assert result.n_test == 80
    assert 0.6 < result.auc <= 1
    for value in (result.precision, result.recall, result.average_precision):
        assert 0 <= value <= 1
    assert list(result.feature_importance) == feature_names()
    assert sum(result.feature_importance.values()) == pytest.approx(1)
    top = top_importances(result.feature_importance)
    assert len(top) == 5 and top[0][0] == "age"
    assert [v for _, v in top] == sorted((v for _, v in top), reverse=True)


def test_training_rows_are_bounded_by_distinct_vectors(cohort, tmp_path, monkeypatch):
    """Ten times the patients with the same features are no more rows to a tree."""
    seen, fit = [], RandomForestClassifier._fit

    def watched(self, rows):
        seen.append(rows.count())
        return fit(self, rows)

    monkeypatch.setattr(RandomForestClassifier, "_fit", watched)
    copies = cohort.crossJoin(cohort.sparkSession.range(10))
    many = copies.withColumn("mrn", F.concat("mrn", F.lit("-"), F.col("id").cast("string"))).drop("id")
    result = train_model(many, str(tmp_path / "forest"), n_estimators=3, max_depth=5)
    assert result.n_train + result.n_test == 4000
    assert seen and max(seen) <= patients_to_features(cohort).distinct().count()
    model = load_model(cohort.sparkSession, result.model_path).stages[-1]
    assert model.getNumTrees == 3 and len(model.trees) == 3 and model.numClasses == 2
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.trees}) == 3


def test_draws_of_equal_rows(spark):
    """n equal rows are drawn Poisson(n) times, however the rows are dealt."""
    rows = spark.range(1000).select((F.col("id") % 7).cast("int").alias("a.b"), (F.col("id") % 7 == 0).alias("label"))
    got = {r["a.b"]: r.draws for r in drawn_vectors(rows, 2000, 5).collect()}
    again = {r["a.b"]: r.draws for r in drawn_vectors(rows.repartition(5), 2000, 5).collect()}
    assert len(got) == 7 and got == again
    assert got != {r["a.b"]: r.draws for r in drawn_vectors(rows, 2000, 6).collect()}
    for draws in got.values():
        assert np.mean(draws) == pytest.approx(143, abs=2)
        assert np.var(draws) == pytest.approx(143, rel=0.2)
    one = spark.range(2000).select(F.xxhash64("id").alias("s"), F.lit(1).alias("n"))
    drawn = [r.d for r in one.select(F.explode(poisson_draws(5, -1)("s", "n")).alias("d")).collect()]
    assert np.mean(drawn) == pytest.approx(1, abs=0.05) and np.var(drawn) == pytest.approx(1, abs=0.1)
    assert np.mean(np.array(drawn) == 0) == pytest.approx(np.exp(-1), abs=0.03)


def test_too_few_rows(cohort, tmp_path):
    with pytest.raises(ValueError, match="at least 30"):
        train_model(cohort.limit(29), str(tmp_path / "m"))


def test_missing_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        Explainer(spark, str(tmp_path / "none"))


def test_contract_of_saved_model(spark, result):
    model = load_model(spark, result.model_path)
    assert model_features(model) == feature_names()
    features = patients_to_features(requests(spark, HIGH), include_label=False)
    with pytest.raises(ValueError, match="retrain"):
        predict_proba(features.select(*[f"`{c}`" for c in features.columns[::-1]]), model)


def test_order_of_scores_and_labels(spark, result):
    model = load_model(spark, result.model_path)
    features = patients_to_features(requests(spark, HIGH, LOW), include_label=False, keep=["mrn"])
    got = {r.mrn: r for r in predict_label(features, model, 0.5, keep=["mrn"]).collect()}
    assert got["HIGH"].probability > got["LOW"].probability
    assert (got["HIGH"].predicted_label, got["LOW"].predicted_label) == (1, 0)


def test_predict_splits_bad_requests_and_keeps_repeats(spark, result):
    model = load_model(spark, result.model_path)
    bad = row("BAD", 500, "M", "2024-06-01", "2024-06-02", None)
    batch = requests(spark, HIGH, HIGH, LOW, bad).withColumn("position", F.lit(1))
    scored, rejected = scoring.predict(batch, model, keep=["position"])
    assert scored.columns == ["mrn", "position", "readmission_probability", "risk_band"]
    assert sorted(r.mrn for r in scored.collect()) == ["HIGH", "HIGH", "LOW"]
    assert [r.reasons for r in rejected.collect()] == [["age"]]
    assert scoring.predict(batch.limit(0), model, keep=["position"])[0].count() == 0


def test_contributions_add_up(cohort, explainer):
    got = scoring.explain(cohort.drop(LABEL), explainer)[0].collect()
    assert len(got) == 400
    for r in got:
        assert [c.feature_name for c in r.contributions] == feature_names()
        total = sum(c.shap_value for c in r.contributions)
        assert total == pytest.approx(r.predicted_probability - r.baseline_probability, abs=1e-9)


def test_explanations_name_clinical_drivers(spark, explainer):
    explained = scoring.explain(requests(spark, HIGH, LOW), explainer)[0]
    top = explained.select("mrn", "predicted_probability", top_contributions(F.col("contributions")).alias("top"))
    got = {r.mrn: r for r in top.collect()}
    names = {c.feature_name for c in got["HIGH"].top}
    assert names & {"age", "dx_I50.9", "length_of_stay_days", "age_bucket_age_70_plus"}
    assert len(got["HIGH"].top) == 5
    sizes = [abs(c.shap_value) for c in got["HIGH"].top]
    assert sizes == sorted(sizes, reverse=True)
    assert got["HIGH"].predicted_probability > got["LOW"].predicted_probability
    assert scoring.explain(requests(spark, HIGH).limit(0), explainer)[0].count() == 0


def test_signs_and_ties(spark):
    made = spark.sql(
        """SELECT array(named_struct('feature_name', 'a', 'feature_value', 1D, 'shap_value', 0.5D),
        named_struct('feature_name', 'b', 'feature_value', 1D, 'shap_value', -0.5D),
        named_struct('feature_name', 'c', 'feature_value', 1D, 'shap_value', 0D),
        named_struct('feature_name', 'd', 'feature_value', 1D, 'shap_value', -0.9D)) c"""
    )
    got = made.select(
        top_contributions(F.col("c"), 3), positive_contributions(F.col("c")), negative_contributions(F.col("c"))
    ).first()
    assert [[c.feature_name for c in part] for part in got] == [["d", "a", "b"], ["a"], ["b", "d"]]


def tree(*nodes):
    """Nodes as (left, right, feature, threshold, negatives, positives)."""
    left, right, feature, threshold, neg, pos = map(np.array, zip(*nodes))
    return Tree(left, right, feature, threshold.astype(float), (neg + pos).astype(float), pos / (neg + pos))


# the second tree tests feature 0 twice on one path
SMALL_FOREST = [
    tree((1, 2, 1, 0.5, 50, 50), (-1, -1, -1, 0, 40, 10), (-1, -1, -1, 0, 10, 40)),
    tree(
        (1, 2, 0, 4.0, 60, 40),
        (3, 4, 2, 0.5, 50, 10),
        (5, 6, 0, 8.0, 10, 30),
        (-1, -1, -1, 0, 30, 2),
        (-1, -1, -1, 0, 20, 8),
        (-1, -1, -1, 0, 9, 5),
        (-1, -1, -1, 0, 1, 25),
    ),
]


def expected_value(t, x, known, node=0):
    if t.left[node] < 0:
        return t.value[node]
    left, right = t.left[node], t.right[node]
    if t.feature[node] in known:
        nxt = left if x[t.feature[node]] <= t.threshold[node] else right
        return expected_value(t, x, known, nxt)
    return sum(expected_value(t, x, known, n) * t.cover[n] for n in (left, right)) / t.cover[node]


def shapley(t, x, i):
    others = [j for j in range(len(x)) if j != i]
    total = 0.0
    for size in range(len(x)):
        weight = factorial(size) * factorial(len(x) - size - 1) / factorial(len(x))
        for s in combinations(others, size):
            total += weight * (expected_value(t, x, {*s, i}) - expected_value(t, x, {*s}))
    return total


def test_against_all_coalitions():
    rows = np.array([[a, b, c] for a in (1, 6, 9) for b in (0, 1) for c in (0, 1)], dtype=float)
    got = forest_contributions(SMALL_FOREST, rows)
    want = [[np.mean([shapley(t, x, i) for t in SMALL_FOREST]) for i in range(3)] for x in rows]
    assert np.allclose(got, want, atol=1e-12)
    assert baseline(SMALL_FOREST) == pytest.approx(0.45)


def grown_tree(rng, depth, covers=200):
    """A tree over three features that tests features again further down."""
    nodes = []

    def grow(level, neg, pos):
        at = len(nodes)
        nodes.append(None)
        if level == depth or (level > 1 and rng.random() < 0.2):
            nodes[at] = (-1, -1, -1, 0, neg, pos)
        else:
            feature = int(rng.integers(3))
            cut = 0.5 if feature == 2 else float(rng.integers(0, 6)) + 0.5
            share = rng.uniform(0.2, 0.8, 2)
            left = grow(level + 1, neg * share[0], pos * share[1])
            right = grow(level + 1, neg * (1 - share[0]), pos * (1 - share[1]))
            nodes[at] = (left, right, feature, cut, neg, pos)
        return at

    grow(0, float(covers), float(covers))
    return tree(*nodes)


def test_many_rows_against_all_coalitions():
    rng = np.random.default_rng(5)
    rows = np.array([[a, b, c] for a in range(7) for b in range(7) for c in (0, 1)], dtype=float)
    rows[3, 0] = np.nan  # goes right everywhere
    for t in (grown_tree(rng, 5), grown_tree(rng, 6), SMALL_FOREST[1]):
        got = forest_contributions([t], rows)
        want = [[shapley(t, x, i) for i in range(3)] for x in rows]
        assert np.allclose(got, want, atol=1e-12)


def test_rows_that_no_test_below_tells_apart_go_down_as_one():
    met = []

    class Value:
        __array_ufunc__ = None

        def __init__(self, value):
            self.value = value

        def __rmul__(self, product):
            met.append(len(product))
            return product * self.value

    t = grown_tree(np.random.default_rng(5), 8)
    rng = np.random.default_rng(6)
    rows = np.stack([rng.uniform(0, 7, 5000), rng.uniform(0, 7, 5000), rng.integers(0, 2, 5000)], axis=1)
    want = tree_contributions(t, rows)
    watched = Tree(t.left, t.right, t.feature, t.threshold, t.cover, [Value(v) for v in t.value])
    assert np.array_equal(tree_contributions(watched, rows), want)
    # at a leaf: three features, each met on the way or not
    assert len(met) == (t.left < 0).sum() and max(met) <= 98 and sum(met) < len(rows)


def test_batch_mean(spark, result):
    model = load_model(spark, result.model_path)
    scored, seen = scoring.with_batch_mean(scoring.predict(requests(spark, HIGH, LOW), model)[0])
    rows = scored.collect()
    assert seen.get["n_scored"] == 2
    assert seen.get["mean_probability"] == pytest.approx(
        np.mean([r.readmission_probability for r in rows])
    )
