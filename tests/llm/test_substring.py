import hashlib
import random
import re
from collections import Counter

import numpy as np

from carelake.llm import substring


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[s : s + 35]) for w in words for s in range(len(w) - 34))
    found = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - 34):
            if seen[tuple(w[s : s + 35])] > 1:
                gone |= set(range(s, s + 35))
        kept = [x for i, x in enumerate(w) if i not in gone]
        digest = hashlib.sha256(" ".join(kept).encode()).hexdigest()
        found.append((str(doc_id), len(w), len(gone), digest))
    return sorted(found)


def made(seed):
    draw = random.Random(seed)

    def fresh(n):
        return [f"{draw.choice('abcé日')}{draw.randrange(10**6)}" for _ in range(n)]

    passages = [fresh(n) for n in (34, 35, 36, 50, 53, 70, 120)]
    rows = []
    for i in range(60):
        words = fresh(draw.choice((0, 5, 34, 35, 60, 100)))
        for p in draw.sample(passages, draw.choice((0, 1, 1, 2))):
            at = draw.randrange(len(words) + 1)
            words = words[:at] + p[draw.randrange(3) :] + words[at:]
        rows.append((i, draw.choice((" ", "\n", " \t ")).join(words)))
    period = fresh(3) * 30
    rows += [(100, " ".join(period)), (101, None), (102, ""), (103, " \n"), (None, rows[3][1]), (104, rows[4][1])]
    return rows + [rows[9], rows[9]]


def test_matches_brute_force(make):
    for seed in (1, 2):
        rows = made(seed)
        got = substring.digests(make(rows, ["key", "places", "repeat_starts", "repeat_key"])).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_copies_within_one_task_and_across_flushes(make, monkeypatch):
    monkeypatch.setattr(substring, "GATHERED", 300)
    rows = made(3)
    got = substring.digests(make(rows).coalesce(1)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_texts_are_rewritten_only_where_words_go(make):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"one  two\n{passage} three"), (2, f"{passage} four"), (3, "left  as\tit is"), (4, None)]
    got = {r.doc_id: r for r in substring.without_repeats(make(rows, ["key"])).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == ["one two three", "four", "left  as\tit is", None]
    assert [got[i].n_chars for i in (1, 2, 3, 4)] == [13, 4, 14, None]
    assert got[1].key == 7


def test_long_texts_and_empty_tables(make):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long), (2, long[: len(long) // 2])]
    got = {r.doc_id: r for r in substring.digests(make(rows)).collect()}
    assert got[2].n_removed >= got[2].n_words - 1 and got[1].n_removed in (got[2].n_words, got[2].n_words - 1)
    assert substring.digests(make([])).count() == 0


def test_any_window_holds_one_aligned_block():
    for start in range(200):
        inside = [b for b in range(0, 300, substring.BLOCK) if start <= b and b + substring.BLOCK <= start + 35]
        assert len(inside) == 1
        assert start in substring.around(np.array(inside), 400)


def test_equal_rows_send_each_place_once(make):
    words = [f"w{i}" for i in range(180)]
    docs = make([(7, " ".join(words))] * 200).coalesce(1)
    slim = docs.selectExpr("xxhash64(doc_id, text) AS key", "text")
    probes = substring.in_tasks(slim, substring._probes(4), substring._kinds(substring.PROBES)).collect()
    assert sum(len(r.hit_at or b"") for r in probes) == 4 * 10  # ten blocks of 18 words, not 200 times ten
    places = substring.in_tasks(
        slim.selectExpr("*", "array(0, 18, 36) AS places"), substring._windows(4), substring._kinds(substring.WINDOWS)
    ).collect()
    done = b"".join(r.done_at or b"" for r in places)
    assert len(done) == 4 * len(substring.around(np.array([0, 18, 36]), 180))


def test_places_are_dealt_and_gathered_once():
    keys, at = np.array([5, 5, -3, 5, -3], dtype=np.int64), np.array([9, 2, 9, 9, 9], dtype=np.uint32)
    dealt = substring._dealt(keys, at, 2)
    assert sum(len(x) for x in dealt["places"].to_pylist()) == 4 * 3
    twice = substring.pa.concat_tables([dealt, dealt])
    assert {r["key"]: r["places"] for r in substring._gathered(twice).to_pylist()} == {5: [2, 9], -3: [9]}
