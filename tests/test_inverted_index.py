import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.operators.inverted_index import InvertedIndex, build_index, list_count, recall
from carelake.operators.nearest import top_k

VECTORS = "point_id long, vector array<double>"


def made(seed, n, dim=8, groups=12):
    """Clustered vectors, a third of them equal."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    rows = [(i, (centres[i % groups] + rng.normal(size=dim) * 0.2).tolist()) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 2)]


def brute(queries, rows, k):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1.0)
    out = set()
    for q, v in queries:
        scored = sorted((-round(float(unit(v) @ unit(w)), 10), d) for d, w in rows)
        out |= {(q, d, i) for i, (_, d) in enumerate(scored[:k], 1)}
    return out


def found(index, spark, queries, k=3, **options):
    asked = spark.createDataFrame(queries, "query_key long, vector array<double>")
    return {(r.query_key, r.document_key, r.rank) for r in index.search(asked, k, **options).collect()}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ivf") / "index")
    rows = made(1, 300)
    df = spark.createDataFrame(rows, VECTORS).withColumn("title", F.concat(F.lit("t"), "point_id"))
    odd = [(900, None), (901, []), (902, [float("nan")] * 8), (None, [1.0] * 8)]
    assert build_index(df.unionByName(spark.createDataFrame(odd, VECTORS).withColumn("title", F.lit("odd"))), path) == 450
    return rows, path, InvertedIndex(spark, path)


@pytest.mark.parametrize("limits", [{}, {"broadcast_values": 0, "block_values": 7 * 8}], ids=["rows scanned", "blocks dealt"])
def test_exact_search_equals_brute_force(spark, stored, limits):
    rows, _, index = stored
    queries = made(2, 40) + [(500, [0.0] * 8), (501, rows[0][1])]
    assert found(index, spark, queries, exact=True, probes=2, **limits) == brute(queries, rows, 3)


@pytest.mark.parametrize("limits", [{}, {"broadcast_values": 0, "block_values": 5 * 8}])
def test_probed_lists_are_ranked_exactly(spark, stored, limits):
    rows, _, index = stored
    queries = made(3, 30)
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    near = lambda v: np.round(index.centroids @ unit(v), 12)
    home = {d: int(near(v).argmax()) for d, v in rows}
    want = set()
    for q, v in queries:
        lists = set(np.argsort(-near(v), kind="stable")[:2].tolist())
        want |= brute([(q, v)], [(d, w) for d, w in rows if home[d] in lists], 3)
    assert found(index, spark, queries, probes=2, **limits) == want


def test_only_probed_lists_are_read(spark, stored):
    rows, _, index = stored
    held = index._members.where(F.col("list_no").isin([3]))
    plan = held._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :]
    assert "list_no" in filters[: filters.index("]")]
    assert 0 < held.count() < 450


def test_members_keep_their_columns(stored):
    rows, _, index = stored
    assert index.members.columns == ["point_id", "vector", "title"]
    assert index.members.count() == 450
    assert {r.title for r in index.members.where("point_id < 2").collect()} == {"t0", "t1"}


def test_odd_queries_find_nothing(spark, stored):
    *_, index = stored
    queries = [(1, None), (2, []), (3, [float("inf")] * 8), (4, [1.0]), (None, [1.0] * 8)]
    assert found(index, spark, queries, exact=True) == set()
    assert found(index, spark, [], exact=True) == set()


def test_empty_and_missing_index(spark, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        InvertedIndex(spark, path)
    assert build_index(spark.createDataFrame([], VECTORS), path) == 0
    assert found(InvertedIndex(spark, path), spark, [(1, [1.0, 2.0])], exact=True) == set()


def test_rebuilding_replaces_and_repeats(spark, tmp_path):
    path = str(tmp_path / "ivf")
    rows = spark.createDataFrame(made(4, 100), VECTORS)
    build_index(rows, path)
    first = InvertedIndex(spark, path).centroids
    assert build_index(rows.repartition(5), path) == 150
    assert np.array_equal(InvertedIndex(spark, path).centroids, first)
    assert len(first) == list_count(150, 8) == 13


def test_recall(spark):
    exact = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 5)], "query_key long, document_key long")
    some = exact.where("document_key < 5")
    assert tuple(recall(some, exact).first()) == (4, 3, 0.75)
    assert tuple(recall(some, exact.limit(0)).first()) == (0, 0, 1.0)


def test_bounded_sizes():
    assert list_count(0, 0) == 1 and list_count(10**12, 64) == 4096 and list_count(10**12, 100_000) == 80


def test_a_query_is_one_row_however_many_lists_it_probes(spark, stored):
    *_, index = stored
    asked = spark.createDataFrame(made(2, 40), "key long, vector array<double>")
    probed = index._probe(asked, len(index.centroids)).collect()
    assert len(probed) == 60 and all(len(r.lists) == 3 for r in probed)


def test_what_a_search_holds_is_bounded_by_its_queries():
    from carelake.operators import nearest

    rng = np.random.default_rng(5)
    queries, rows = rng.normal(size=(3, 4)), np.repeat(rng.normal(size=(1, 4)), 50, axis=0)
    best = nearest.Best(3, 2)
    for at in range(0, 1_000, 50):
        best.add(queries, np.arange(at, at + 50), rows)
    assert best._held <= 12 + nearest.PAIRS_PER_STEP and len(best.pairs()) == 6
    # equal rows tie: the smallest keys stay, and what is held no longer grows
    assert best.pairs()["d"].tolist() == [0, 1] * 3 and best._held == 6


@pytest.mark.parametrize("block_values", [1, 24, 10**6])
def test_blocks_hold_whole_lists_or_parts_of_one(stored, block_values):
    *_, index = stored
    blocks = index._blocks(block_values)
    rows = max(1, block_values // 8)
    filled = {}
    for no, (first, parts) in blocks.items():
        n = index.sizes[no][0]
        assert parts == max(1, -(-n // rows))
        if parts == 1:
            filled[first] = filled.get(first, 0) + n
    assert set(blocks) == set(index.sizes) and all(n <= rows for n in filled.values())


def test_blocks_of_four_tasks_fit_a_quarter_of_their_memory():
    from carelake.operators import nearest

    copies, sides, tasks = 3, 2, 4  # as read, as doubles and in key order
    assert 8 * nearest.BLOCK_VALUES * copies * sides * tasks < 1e9
    assert 8 * nearest.BROADCAST_VALUES * copies * tasks < 1e9


def test_a_pair_of_full_blocks_takes_a_bounded_part_of_a_worker():
    """Matrices, similarities and what is found, without Arrow's own memory."""
    import tracemalloc

    import pyarrow as pa

    from carelake.operators import nearest

    rows = nearest.BLOCK_VALUES // 64
    numbers = np.random.default_rng(1).normal(size=(2, rows * 64)).astype("float32")
    left, right = (
        pa.table({"key": np.arange(rows), "vector": pa.FixedSizeListArray.from_arrays(n, 64).cast(pa.list_(pa.float32()))})
        for n in numbers
    )
    tracemalloc.start()
    found = nearest.block_result(left, right, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 3 * rows and peak < 130e6


def test_what_many_queries_found_is_sorted_out_early():
    from carelake.operators import nearest

    angles = np.linspace(1.5, 0, 300)  # each row is nearer than those before
    best, queries = nearest.Best(1000, 2), np.tile([1.0, 0.0], (1000, 1))
    held = 0
    for at, angle in enumerate(angles):
        best.add(queries, np.array([at]), np.array([[np.cos(angle), np.sin(angle)]]))
        held = max(held, best._held)
    assert held <= 210_000 and best.pairs()["d"].tolist() == [299, 298] * 1000
