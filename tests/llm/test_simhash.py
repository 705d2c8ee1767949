import random
import re

import numpy as np
import pytest
import xxhash

from carelake.llm import simhash
from carelake.llm.components import connected_components, local_stars


def brute_print(text):
    plain = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", plain)
    n = len(words)
    shingles = [" ".join(words[i : i + 3]) for i in range(n - 2)] if n >= 3 else [" ".join(words)] * bool(n)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    for a in nodes:
        for b in nodes:
            if linked(a, b):
                low, high = sorted((label[a], label[b]))
                label = {n: low if x == high else x for n, x in label.items()}
    return label


def texts(seed, n):
    draw = random.Random(seed)
    words = ["ab", "Cd", "Éf", "gh.", "ij", "KL", "mn", "日本", "o p", "qr"]
    made = []
    for _ in range(n):
        if made and draw.random() < 0.5:
            words_of = draw.choice(made).split(" ")
            words_of[draw.randrange(len(words_of))] = draw.choice(words)
            made.append(" ".join(words_of))
        else:
            made.append(" ".join(draw.choice(words) + str(draw.randrange(30)) for _ in range(draw.choice((1, 2, 3, 40, 90)))))
    return made


def test_every_word_decodes_to_the_nearest_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000, dtype=np.uint32)
    index = simhash.golay_index(words)
    messages = np.arange(4096, dtype=np.uint32) << 11
    code = np.array([int(m) | simhash._remainder(int(m)) for m in messages], dtype=np.uint32)
    assert min(int(c).bit_count() for c in code[1:]) == 7
    far = np.bitwise_count(code[index] ^ words)
    assert far.max() <= 3
    assert (np.bitwise_count(code[None, :] ^ words[:200, None]).min(axis=1) == far[:200]).all()


@pytest.mark.parametrize("flips", [0, 1, 2, 3])
def test_prints_up_to_three_bits_apart_share_a_key(flips):
    rng = np.random.default_rng(flips)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = a.copy()
    for _ in range(flips):
        b ^= np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
    row, key = simhash.fuzzy_keys(np.concatenate([a, b]))
    keys = [set() for _ in range(6000)]
    for r, k in zip(row.tolist(), key.tolist()):
        keys[r].add(k)
    assert all(keys[i] & keys[i + 3000] for i in range(3000))


def test_matches_brute_force(spark, make):
    rows = list(enumerate(texts(3, 150))) + [(900, None), (901, ""), (902, " \n"), (903, None)]
    rows += [(5, rows[5][1]), (None, rows[7][1]), (None, "alone and without a name " * 9)]
    got = simhash.near_duplicates(make(rows, ["print", "key", "row_key", "component_id"])).collect()
    prints = {(i, t): brute_print(t) for i, t in rows}
    nodes = sorted(set(prints.values()))
    label = brute_components(nodes, lambda a, b: (a ^ b).bit_count() <= 3)
    first = {}
    for (i, _), p in prints.items():
        if i is not None:
            first[label[p]] = min(first.get(label[p], i), i)
    want = sorted((str(i), format(prints[i, t], "016x"), first.get(label[prints[i, t]])) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == [
        (i, p, c) for i, p, c in sorted(want, key=lambda x: (x[0], x[1]))
    ]


def test_a_dense_group_is_split_in_blocks_and_stays_whole(spark):
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 1 << 62))
    near = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 12, (400, 2))}
    rows = [(p,) for p in near] + [(int(x),) for x in rng.integers(0, 1 << 62, 50)]
    prints = spark.createDataFrame(rows, "print long")
    links = simhash.fingerprint_links(prints, block=8)
    assert links.count() < 72 * len(rows)
    labels = {r.node: r.component for r in connected_components(links).collect()}
    assert {labels[p] for p in near} == {min(near)}


def test_one_of_each_group_stays_once(make):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text), (2, text + " end"), (2, text + " end"), (9, text), (7, "other words stand here alone"), (None, text)]
    kept = simhash.one_of_each_group(make(rows, ["row_key", "gone_key"]))
    assert kept.columns[-2:] == ["row_key", "gone_key"]
    first = brute_components([brute_print(t) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    assert first[brute_print(text)] == first[brute_print(text + " end")]
    assert sorted(r.doc_id for r in kept.collect()) == [2, 7]


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0
    assert simhash.one_of_each_group(make([])).count() == 0


def test_components_match_brute_force(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(0, i) for i in range(1000, 1400)]
    edges += [(i, i + 1) for i in range(2000, 2100)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes, low = local_stars(np.array([a for a, _ in real]), np.array([b for _, b in real]))
    assert got == dict(zip(nodes.tolist(), low.tolist()))
    joined = {frozenset(e) for e in real}
    label = brute_components(sorted({n for e in real for n in e}), lambda a, b: frozenset((a, b)) in joined)
    assert got == label
