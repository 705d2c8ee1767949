import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import block_neighbors as bn

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, k):
    """Ranks of every query by plain loops; equal rows count once."""
    good = {
        (i, tuple(v))
        for i, v, _ in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = []
    for i, v in good:
        if i % 100:
            continue
        with np.errstate(over="ignore"):
            gap = lambda w: float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()))
            near = sorted((gap(w), j) for j, w in good if (j, w) != (i, v) and len(w) == len(v))
        out += [(i, rank, j, d) for rank, (d, j) in enumerate(near[:k], 1)]
    return sorted(out)


def found(spark, rows, k=10):
    df = spark.createDataFrame(rows, VECTORS).withColumns({"ids": F.lit(1), "vector": F.lit("x"), "dim": F.lit(2)})
    got = bn.nearest(df, df.where("vec_id % 100 = 0"), k).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def assert_same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(bn, "LEAST_ROWS", 40)
    monkeypatch.setattr(bn, "TILE_QUERIES", 3)
    monkeypatch.setattr(bn, "TILE_CANDIDATES", 16)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    rows = np.concatenate([rng.normal(size=(60, 2500)), rng.normal(size=(40, 2500)) * 1e-3, rng.normal(size=(20, 2500)) * 1e6])
    codes, scale, error = bn.quantised(rows)
    row = {
        "codes": codes.tobytes(), "scale": scale.tobytes(), "error": error.tobytes(), "numbers": rows.tobytes(),
        "square": (codes.astype(float) ** 2).sum(axis=1).tobytes(),
        "ids": np.arange(120).tobytes(), "ends": np.arange(1, 121).tobytes(),
    }
    block = bn.Block(row, 2500, np.float64)
    assert (bn.products(codes, codes) == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    lower, upper = bn.bounds(block, slice(0, 120), block, slice(0, 120))
    exact = np.stack([bn.distances(r, rows) for r in rows])
    assert (lower <= exact).all() and (exact <= upper).all()


def test_equals_brute_force_over_many_blocks(spark, small_blocks):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(size=8) * 10.0 ** -(i % 6)).tolist(), 0) for i in range(600)]
    rows += [(1000 + i, (rng.integers(0, 3, 3) + 0.5).tolist(), 0) for i in range(300)]  # ties, another length
    assert_same(found(spark, rows), brute(rows, 10))


def test_a_third_of_copies_and_a_dense_group(spark, small_blocks):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(0, 900, 3)]
    rows += [(i, (np.array([1.0, 2.0, 3.0]) + rng.normal(size=3) * 1e-6).tolist(), 0) for i in range(1, 900, 3)]
    rows += [(i, rng.normal(size=3).tolist(), 0) for i in range(2, 900, 3)]
    assert_same(found(spark, rows), brute(rows, 10))


def test_odd_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 0), (0, [1.0, 0.0], 1), (0, [0.0, 2.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], None),
        (2, None, 0), (3, [], 0), (4, [0.0, 0.0], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [None, 1.0], 0),
        (None, [1.0, 0.5], 0), (100, [1.0, 2.0, 3.0], 0), (200, [0.0, 0.0], 0), (-100, [1e200, 0.0], 0), (8, [5e-324, 0.0], 0),
    ]
    assert_same(found(spark, rows, 3), brute(rows, 3))


def test_few_or_no_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0), (2, [2.0], 0)]) == []
    assert found(spark, [(100, [1.0], 0)]) == []
    assert found(spark, [(100, [1.0], 0), (1, [3.0], 0)]) == [(100, 1, 1, 2.0)]
