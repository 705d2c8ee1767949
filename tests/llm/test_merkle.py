import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from carelake.llm import merkle

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def folded(nodes):
    """Root of a list of digests, and for each the siblings (before, behind) per level."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), 16):
            run = nodes[at : at + 16]
            for place in range(len(run)):
                for i in under[at + place]:
                    paths[i].append((run[:place], run[place + 1 :]))
            up.append(H(*run))
            held.append([i for u in under[at : at + 16] for i in u])
        nodes, under = up, held
    return nodes[0], paths


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    per = {}
    for s in sources:
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        per[s] = (mine, *folded([leaf_of(r) for r in mine]))
    root, upper = folded([per[s][1] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        mine, subroot, paths = per[s]
        for row, path in zip(mine, paths):
            whole = path + above
            small = row[1] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            at = leaf_of((row[0], small, *row[2:])) if bad else leaf_of(row)
            for before, behind in whole:
                at = H(*before, at, *behind)
            proof = H(*(d for before, behind in whole for d in before + behind))
            out.append((row[0], leaf_of(row), subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in ("key", "idx", "leaf", "digest", "s", "n", "other")})
    got = merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [300, 1, 16, 17, 33, 2], [257] + [3] * 20])
def test_equals_brute_force(spark, sizes):
    draw = random.Random(sum(sizes))
    rows = []
    for s, n in enumerate(sizes):
        for _ in range(n):
            text = draw.choice([None, "", "Plain Text", "lower only", "Éé 日本 X" * draw.randrange(9)])
            rows.append((draw.randrange(10**6), text, draw.choice(["en", None]), draw.choice(["b", "é", "a "]) + str(s) if len(sizes) < 3 else f"s{s}", draw.choice([3, None])))
    assert found(spark, rows) == brute(rows)


def test_nulls_repeats_and_a_hot_source(spark):
    rows = [(i, f"Text {i}", "en", None if i % 3 == 0 else f"src{i % 7}", i) for i in range(400)]
    rows += [(None, "No id", "en", "src1", 1), (None, None, None, None, None)] * 3
    rows += [(5, "Text 5", "en", "src5", 5)] * 200 + [(5, "other", "de", "src5", 9)] * 2
    rows += [(1, "e", "en", "", 1)]
    assert found(spark, rows) == brute(rows)


def test_long_text_and_no_rows(spark):
    assert found(spark, []) == []
    rows = [(25, "Wörd " * 400_000, "en", "s", 1), (26, "x", "en", "s", 1)]
    assert found(spark, rows) == brute(rows)


def test_rounds_grow_with_the_logarithm_of_the_depth(spark, monkeypatch):
    """Five levels over one source of 5,000 leaves and two over 20 sources: three joins."""
    seen = []
    real = merkle.broadcast_if_small
    monkeypatch.setattr(merkle, "broadcast_if_small", lambda df, limit: seen.append(df.columns) or real(df, limit))
    rows = [(i, "t", "en", "a", 1) for i in range(5000)] + [(i, "t", "en", f"b{i}", 1) for i in range(20)]
    assert found(spark, rows) == brute(rows)
    assert sum("more" in columns for columns in seen) == 3
