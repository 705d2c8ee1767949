import pytest
from pyspark.sql import functions as F

from carelake.operators.lookup import attach


def test_small_lookup_is_broadcast_and_keeps_unmatched_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, k string")
    lookup = spark.createDataFrame([("a", 10)], "k string, v int")
    joined = attach(rows, lookup, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.v) for r in joined.collect()) == [(1, 10), (2, None), (3, 10)]


def test_hot_key_of_a_large_lookup_is_split(spark):
    """A third of the rows share a key; beyond the size limit AQE splits them."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 30_000, 1, 12).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")
        )
        lookup = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = attach(rows, lookup, "k", limit=1000)
        got = joined.agg(F.count("v"), F.sum("v"))
        assert tuple(got.first()) == (30_000, 2 * sum(i for i in range(30_000) if i % 3))
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_key_filter_passes_all_members_and_few_others(spark):
    from carelake.operators.key_filter import KeyFilter

    members = spark.range(20_000).selectExpr("concat('m', id) AS mrn")
    others = spark.range(20_000).selectExpr("concat('x', id) AS mrn")
    made = KeyFilter.of(members, "mrn")
    assert made.keep(members, "mrn").count() == 20_000
    assert made.keep(others, "mrn").count() < 200
    assert KeyFilter.of(members, "mrn", max_bits=1000) is None
    assert KeyFilter.of(members.limit(0), "mrn").keep(others, "mrn").count() == 0


@pytest.mark.parametrize("limits", [{}, {"limit": -1}, {"limit": -1, "max_bits": 0}], ids=["sent", "filtered", "shuffled"])
def test_conflicts_are_exact_whichever_way(spark, limits):
    from carelake.operators.mutate import duplicate_mrns

    stored = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 'hot' WHEN id < 1005 THEN NULL ELSE concat('m', id) END AS mrn")
    batch = spark.createDataFrame([("m1500",), ("new",), ("new",), ("hot",), (None,), ("x",)], "mrn string")
    got = [r.mrn for r in duplicate_mrns(stored, batch, **limits).collect()]
    assert sorted(got) == ["hot", "m1500", "new"]
