"""Mixing, URL lists, vectors and the pipeline."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.llm import graph_neighbors, mixing, simhash, url_filter

# --- mixing ---------------------------------------------------------------------


def test_raked_marginals_meet_their_targets(spark):
    draw = random.Random(1)
    rows = [(s, lang, t, draw.randrange(1, 1000)) for s in "abc" for lang in ("en", "de") for t in ("x", "y")]
    cells = spark.createDataFrame([*rows, ("a", "en", "z", 0)], "source string, lang string, topic string, tokens long")
    goals = {"source": {"a": 0.2, "b": 0.3, "c": 0.5}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}}
    targets = {d: spark.createDataFrame(list(g.items()), f"{d} string, target double") for d, g in goals.items()}
    fitted = mixing.raked(cells, targets, cycles=30).toPandas()
    for d, goal in goals.items():
        shares = fitted.groupby(d)["weight"].sum() / fitted["weight"].sum()
        assert all(abs(shares[v] - share) < 1e-6 for v, share in goal.items())
    known = mixing.probabilities(mixing.raked(cells, targets, cycles=30), 0.3).toPandas()
    assert known["probability"].between(0, 1).all()
    assert abs((known["tokens"] * known["probability"]).sum() / known["tokens"].sum() - 0.3) < 1e-3


def test_draws_follow_the_probabilities(make):
    rows = [(i, "word " * (i % 40 + 1), "en" if i % 3 else "de", f"s{i % 5}") for i in range(3000)]
    rows += [(9001, None, None, None), (9002, "", "en", "s1"), (None, "no id", "en", "s0")]
    docs = make(rows, ["mix_tokens", "topic", "probability"])
    judged = mixing.mixed(docs).collect()
    assert len(judged) == len(rows)
    expected = sum(r.n_tokens * r.probability for r in judged)
    assert abs(expected / sum(r.n_tokens for r in judged) - mixing.BUDGET) < 0.01
    drawn = sum(r.n_tokens for r in judged if r.selected)
    assert abs(drawn / expected - 1) < 0.05
    kept = mixing.select_mixed(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in judged if r.selected)


def test_mixing_without_words_or_rows(make):
    assert [r.selected for r in mixing.mixed(make([(1, None), (2, " ")])).collect()] == [False, False]
    assert mixing.mixed(make([])).count() == 0 and mixing.select_mixed(make([])).count() == 0


# --- URL lists ------------------------------------------------------------------


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_captures_meet_the_entries_of_their_day(spark):
    draw = random.Random(3)
    keys = ["a.com", "b.a.com", "x.b.a.com", "c.org", "org"]
    entries = [(draw.choice(keys), day(draw.randrange(40)), draw.choice(("block", "allow"))) for _ in range(40)]
    odd = [(None, day(1), "block"), ("a.com", None, "block"), ("c.org", day(0), "other")]
    hosts = ["a.com", "b.a.com", "x.b.a.com", "y.x.b.a.com", "c.org", "d.net", "xa.com"]
    captures = [(i, f"http://u@{draw.choice(hosts).upper()}:80/p?q", day(draw.randrange(50))) for i in range(300)]
    captures += [(900, None, day(3)), (901, "not a url", day(3)), (902, "http://a.com/", None), (1, *captures[1][1:])]
    got = url_filter.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, fetched date").withColumn("key", F.lit(1)),
        spark.createDataFrame(entries + odd, "key string, since date, action string"),
    ).collect()
    assert len(got) == len(captures)
    for r in got:
        best = None
        if r.host and r.fetched:
            labels = r.host.split(".")
            for key in (".".join(labels[i:]) for i in range(len(labels))):
                held = [(s, a) for k, s, a in entries if k == key and s <= r.fetched]
                if held:
                    best = (key, *max(held))
                    break
        assert (r.matched, r.listed_since, r.action) == (best or (None, None, None))
        assert r.blocked == bool(best and best[2] == "block")


@pytest.mark.parametrize(
    "url, host",
    [
        ("http://A.b.C:80/x", "a.b.c"),
        ("  \t\nhttps://a.b./", "a.b"),
        ("http://[2001:DB8::1]:80/x", "[2001:db8::1]"),
        ("http://u:p@[::1]/", "[::1]"),
        ("http://a@b@c.d/e@f", "c.d"),
        ("http://[::1/x", None),
        ("http:///x", None),
        ("no address", None),
        ("http://" + "a." * 126 + "b", "a." * 126 + "b"),
        ("http://" + "a." * 127 + "b", None),
        (None, None),
    ],
)
def test_hosts_of_addresses(spark, url, host):
    df = spark.createDataFrame([(url,)], "url string").select(url_filter.host_of(F.col("url")).alias("host"))
    assert df.first().host == host


def test_numeric_hosts_have_no_parents(spark):
    captures = spark.createDataFrame([(1, "http://[::ffff:1.2.3.4]/", day(5)), (2, "http://x.a.b/", day(5))], "page_id long, url string, fetched date")
    entries = spark.createDataFrame([("4]", day(1), "block"), ("b", day(1), "block")], "key string, since date, action string")
    assert {r.page_id: r.blocked for r in url_filter.evaluate(captures, entries).collect()} == {1: False, 2: True}


def test_long_intervals_and_hot_keys(spark):
    """Years between the entries of a key, and a key that all hosts share."""
    captures = [(i, f"http://h{i % 50}.hot.com/", dt.date(2000, 1, 1) + dt.timedelta(days=37 * i)) for i in range(300)]
    entries = [("hot.com", dt.date(1990, 5, 5), "block"), ("hot.com", dt.date(2005, 2, 28), "allow"), ("hot.com", dt.date(2005, 3, 1), "block"), ("hot.com", dt.date(2090, 1, 1), "allow"), ("h3.hot.com", dt.date(2012, 12, 31), "allow")]
    got = url_filter.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, fetched date"),
        spark.createDataFrame(entries, "key string, since date, action string"),
    ).collect()
    for r in got:
        allowed = r.fetched == dt.date(2005, 2, 28) or r.host.startswith("h3.") and r.fetched >= dt.date(2012, 12, 31)
        assert r.blocked == (not allowed)


def test_empty_lists_and_captures(spark):
    captures = spark.createDataFrame([(1, "http://a.b/", day(1))], "page_id long, url string, fetched date")
    entries = spark.createDataFrame([("b", day(1), "block")], "key string, since date, action string")
    assert [r.blocked for r in url_filter.evaluate(captures, entries.limit(0)).collect()] == [False]
    assert url_filter.evaluate(captures.limit(0), entries).count() == 0


# --- vectors --------------------------------------------------------------------


def brute_links(rows, threshold=0.9):
    def fine(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [np.array(v, dtype=float) / np.linalg.norm(v) if fine(v) else None for _, v in rows]
    near = [
        [j for j, b in enumerate(units) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= threshold]
        for i, a in enumerate(units)
    ]
    label = list(range(len(rows)))
    while True:
        new = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    named = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            named[c] = min(named.get(c, i), i)
    return [(str(i), len(n), named.get(c) if units[k] is not None else i) for k, ((i, _), n, c) in enumerate(zip(rows, near, label))]


def clustered(n, seed=0, size=16):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(size) for _ in range(n)]
    rows += [rows[i % 7] + 0.1 * rng.standard_normal(size) for i in range(n // 2)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("sizes", [{}, {"shard": 60, "part": 40, "chunk": 70}])
def test_links_match_brute_force(spark, sizes):
    rows = clustered(300)
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [1.0, None] * 8), (1004, [float("nan")] * 16)]
    rows += [(1005, [float("inf")] * 16), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (1008, rows[3][1]), (1009, rows[3][1])]
    rows += [rows[4], (None, rows[5][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS node", "2 AS label")
    judged = graph_neighbors.near_vectors(frame, **sizes)
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in judged.collect())
    want = sorted(brute_links(rows))
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found <= true and found >= (0.97 if sizes else 1) * true
    if not sizes:
        assert got == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in judged.collect())
    found, true = graph_neighbors.audit_recall(frame, judged, every=7)
    assert true > 0 and found >= 0.9 * true


def test_a_dense_group_over_many_shards_is_found_whole(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal(32)
    rows = [base + 0.15 * rng.standard_normal(32) for _ in range(1200)] + list(rng.standard_normal((2400, 32)))
    units = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = (units @ units.T >= 0.9).sum(axis=1) - 1
    assert near[:1200].min() > 1000
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    # shards of about 15, blocks of 600 nodes
    judged = graph_neighbors.near_vectors(frame, shard=15, numbers=600 * 32).cache()
    nodes = graph_neighbors.distinct_nodes(graph_neighbors.with_node(frame))
    homes = graph_neighbors.shard_rows(nodes, 15)[0].where("home").join(nodes.where("first < 1200").select("node"), "node")
    assert homes.select("shard").distinct().count() >= 25
    found, true = graph_neighbors.audit_recall(frame, judged, every=7)
    assert true > 100_000 and found <= true and found >= 0.99 * true
    assert {r.component_id for r in judged.where("vec_id < 1200").collect()} == {0}


def test_star_links_connect_what_all_links_connect():
    draw = np.random.default_rng(4)
    for share in (0.01, 0.1, 0.6):
        hits = draw.random((60, 50)) < share
        row, column, one, other = graph_neighbors.star_links(hits)
        assert hits[row, column].all()
        r, c = np.nonzero(hits)
        want = graph_neighbors.local_stars(r, c + 60)
        got = graph_neighbors.local_stars(np.concatenate([row, one]), np.concatenate([column + 60, other]))
        assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert graph_neighbors.near_vectors(frame).count() == 0


# --- the pipeline ---------------------------------------------------------------


def test_the_pipeline_keeps_what_its_stages_keep(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "substring", "mixing", "packing"]
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in rows.select("doc_id").collect()}
        rows = stage(spark, rows, sf_dir).cache()
        assert rows.columns == docs.columns
        assert {r.doc_id for r in rows.select("doc_id").collect()} <= before
    packed = corpus_pipeline.run(spark, sf_dir).select("doc_id").distinct()
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in rows.select("doc_id").collect()}


def test_stages_on_odd_rows(spark, make):
    """Nulls, empty texts, repeated rows and clashing names through every stage."""
    import corpus_pipeline

    draw = random.Random(3)
    text = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    shared = text(60)
    rows = [(10**6 + i, text(80)) for i in range(30)] + [(2 * 10**6, shared + " " + text(40)), (2 * 10**6 + 1, text(40) + " " + shared)]
    rows += [(3 * 10**6, None), (3 * 10**6 + 1, ""), (None, text(50)), (None, None), rows[0], rows[0]]
    names = ["key", "row_key", "places", "topic", "curve", "group_print", "score"]
    docs = make(rows, names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
        assert docs.columns == [*make([]).columns, *names]
        if name == "toxicity":
            assert docs.count() == before  # the labels are of other documents
        if name == "simhash":
            kept = [r.doc_id for r in docs.collect()]
            assert kept.count(10**6) == 1 and len([i for i in kept if i and i >= 3 * 10**6]) == 1
        if name == "substring":
            assert docs.count() == before
            assert not any(shared in (r.text or "") for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {str(r.doc_id) for r in packed.select("doc_id").distinct().collect()} == {str(r.doc_id) for r in docs.collect()}


def test_stages_on_an_empty_table(spark, make):
    import corpus_pipeline

    docs = make([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0 and docs.columns == make([]).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0
