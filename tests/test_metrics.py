import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import metrics
from carelake.operators.metrics import binary_metrics, class_weights, positive_rate
from carelake.operators.ranking import number_by_digest, stratified_split


def by_hand(pairs, threshold):
    """AUC over all pairs and the step sum over distinct thresholds."""
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    hit = [(s, y) for s, y in pairs if s >= threshold]
    tp = sum(y for _, y in hit)
    steps, last = 0.0, 0.0
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        above = [y for s, y in pairs if s >= cut]
        recall = sum(above) / len(pos)
        steps += (recall - last) * sum(above) / len(above)
        last = recall
    return won / (len(pos) * len(neg)), tp / len(hit), tp / len(pos), steps


@pytest.mark.parametrize("ranges", [1024, 8, 2])
def test_against_definitions(spark, monkeypatch, ranges):
    monkeypatch.setattr(metrics, "RANGES", ranges)
    rng = random.Random(7)
    pairs = [(round(rng.random(), 2), rng.random() < 0.3) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, label boolean").repartition(4)
    got = binary_metrics(df, "score", "label", 0.6).first()
    assert (got.n, got.n_positive) == (400, sum(y for _, y in pairs))
    assert (got.auc, got.precision, got.recall, got.average_precision) == pytest.approx(
        by_hand(pairs, 0.6)
    )


def test_rows_without_score_or_label_are_left_out(spark):
    pairs = [(0.1, False), (0.4, True), (0.4, False), (0.8, True), (float("inf"), False)]
    odd = [(None, True), (float("nan"), True), (float("nan"), False), (0.9, None)]
    df = spark.createDataFrame(pairs + odd, "score double, label boolean")
    got = binary_metrics(df, "score", "label", 0.3).first()
    assert (got.n, got.n_positive) == (5, 2)
    assert (got.auc, got.precision, got.recall, got.average_precision) == pytest.approx(
        by_hand(pairs, 0.3)
    )


def test_missing_classes(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 0)], "score double, label int")
    got = binary_metrics(df, "score", "label").first()
    assert (got.n_positive, got.auc) == (0, None)
    assert (got.precision, got.recall, got.average_precision) == (0.0, 0.0, 0.0)
    assert binary_metrics(df.limit(0), "score", "label").first().n == 0


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(True,)] * 2 + [(False,)] * 8, "y boolean")
    got = {r.y: r.class_weight for r in class_weights(df, "y").collect()}
    assert got == {True: 10 / 4, False: 10 / 16}
    assert positive_rate(df, "y").first()[0] == 0.2


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("M"), "id").alias("mrn"), (F.col("id") < 137).alias("y")
    )
    first = stratified_split(df, "mrn", "y")
    counts = {(r.y, r.is_test): r["count"] for r in first.groupBy("y", "is_test").count().collect()}
    assert counts == {(True, True): 27, (True, False): 110, (False, True): 173, (False, False): 690}
    again = stratified_split(df.repartition(5), "mrn", "y")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    other = stratified_split(df, "mrn", "y", seed=1)
    assert sorted(map(tuple, first.collect())) != sorted(map(tuple, other.collect()))


def test_split_sizes_at_the_ends(spark):
    df = spark.range(3).select(F.col("id").alias("mrn"), F.lit(True).alias("y"))
    for size, want in ((0.0, 0), (0.1, 0), (0.5, 2), (1.0, 3)):
        got = stratified_split(df, "mrn", "y", test_size=size)
        assert (got.count(), got.filter("is_test").count()) == (3, want)


def test_numbers_are_dense_and_start_where_told(spark):
    df = spark.range(500).select(F.col("id").alias("key"))
    got = number_by_digest(df, "key", "no", 11)
    assert sorted(r.no for r in got.collect()) == list(range(11, 511))
