import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from carelake.llm import spelling


def edits(a, b):
    """Edit distance by the whole matrix."""
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 199 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1 :]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def found(rows, make):
    docs = make([(*r, "en", "s") for r in rows], ["word", "n", "form", "key"])
    got = spelling.variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted(tuple(r) for r in got)


def corpus(seed, n):
    draw = random.Random(seed)
    letters = "abcÀéÿ÷×t"
    stems = ["".join(draw.choice(letters) for _ in range(draw.randrange(6, 10))) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(40):
            w = draw.choice(stems[: draw.randrange(1, 25)])
            if draw.random() < 0.3:
                at = draw.randrange(len(w))
                w = w[:at] + draw.choice(["", draw.choice(letters), draw.choice(letters) + w[at]]) + w[at + 1 :]
            words.append(w.upper() if draw.random() < 0.1 and w.isascii() else w)
        rows.append((i, draw.choice([" ", "-", "1", "Š"]).join(words)))
    # each is one edit from the one before it, and two from the one before that
    chain = "zzzzzza " * 300 + "zzzzzzb " * 40 + "zzzzzbb " * 6
    return rows + [(n + i, w) for i, w in enumerate(chain.split())]


@pytest.mark.parametrize("bucket", [1, 64])
def test_equals_brute_force_with_small_and_hot_buckets(make, monkeypatch, bucket):
    rows = corpus(bucket, 300)
    one = spelling.near_pairs.__defaults__
    monkeypatch.setattr(spelling.near_pairs, "__defaults__", (one[0], bucket))
    want = brute(rows)
    assert any(r[3] for r in want) and any(r[5] != r[3] and r[3] for r in want)
    assert found(rows, make) == want


@pytest.mark.parametrize("keys", [1, 1 << 20])
def test_neighbourhoods_are_full(monkeypatch, keys):
    monkeypatch.setattr(spelling, "KEYS", keys)
    words = ["", "a", "b", "ab", "aa", "abcabca", "aaaaaaa", "bbccaab"]
    got = [[] for _ in words]
    for places, codes in spelling.by_length(words, 1000):
        for rows, hashes in spelling.neighbour_keys(codes, 3):
            for row, key in zip(places[rows], hashes.tolist()):
                got[row].append(key)
    for word, found in zip(words, got):
        near = {word}
        for i in range(len(word) + 1):
            near |= {word[:i] + s + word[i:] for s in "abc"}
            if i < len(word):
                near |= {word[:i] + s + word[i + 1 :] for s in ("", "a", "b", "c")}
        keys_of = {int(spelling.keys_of(codes)[0]) for w in near for _, codes in spelling.by_length([w], 9)}
        assert len(found) == len(set(found)) == len(near)
        assert set(found) == keys_of


def test_long_runs_and_odd_rows(make, monkeypatch):
    monkeypatch.setattr(spelling, "KEYS", 1 << 12)
    long = "abcdefghij" * 2_000
    rows = [(i, f"{long} {long[:-1]}") for i in range(4)] + [(9, f"{long} " * 30 + long[:-1] + " ")]
    rows += [(None, "ignored Ignored ignored ignored ignored"), (10, None), (11, ""), (12, "!!"), (12, "twicer " * 5)] * 2
    got = {r[0]: r[1:] for r in found(rows, make)}
    want = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z]+", text or ""):
            want[spelling.spelled(run, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))] += 1
    assert {w: r[0] for w, r in got.items()} == {w: n for w, n in want.items() if n >= 5 and len(w) > 5}
    if got.get(long) and got.get(long[:-1]):
        assert got[long][1] == got[long[:-1]][1] == 1
        assert got[long[:-1]][2:] == (long, got[long][0], long)


def test_no_words(make):
    assert found([], make) == [] and found([(1, None), (2, "few words")], make) == []


def test_a_hot_reduced_word_costs_no_pairs(spark):
    """A third of the words share one reduced word."""
    same = [c for c, s in zip(spelling.LETTERS, spelling.alphabet(spelling.SYMBOLS)) if s == spelling.alphabet(spelling.SYMBOLS)[0]]
    draw = random.Random(4)
    words = {"".join(draw.choice(same) for _ in range(6)) for _ in range(400)}
    words |= {"".join(draw.choice("abcdefghijklm") for _ in range(7)) for _ in range(800)}
    got = spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string").withColumn("n", F.lit(5)))
    want = {(a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and edits(a, b) == 1}
    rows = [(r.word, r.near) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
