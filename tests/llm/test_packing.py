import itertools
import random
import zlib

import numpy as np
import public_tokenizers as public
from tokenizers import Tokenizer

from carelake.llm import packing
from carelake.llm.pipeline import packing_files


def test_the_curve_visits_every_cell_by_unit_steps():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_word_tokens_match_the_tokenizer():
    tokens = packing.WordTokens(*packing_files())
    draw = random.Random(4)
    parts = ["a", "the", " ", "  ", "\n", "é", "日本", "\t", "<|endoftext|>", "😀", "'s", "123", "!!", "\r\n", "\x85", "\x1c", "　", "\xa0"]
    for _ in range(1500):
        text = "".join(draw.choice(parts) + draw.choice(("", " ")) for _ in range(draw.randrange(25)))
        assert tokens.ids(text).tolist() == tokens.whole.encode(text, add_special_tokens=False).ids


def test_tails_are_powers_of_two():
    for left in range(2048):
        parts = packing.tail_lengths(left)
        assert sum(parts) == left and all(p & (p - 1) == 0 for p in parts)


def check(rows, pieces):
    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = sorted(
        (str(i), len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        for i, t in rows
        for ids in [whole.encode(t or "", add_special_tokens=False).ids + [1]]
    )
    assert sorted({(str(p.doc_id), p.doc_tokens) for p in pieces}) == sorted({w[:2] for w in want})
    assert sum(p.length for p in pieces) == sum(w[1] for w in want)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == packing.LENGTH or at & (at - 1) == 0 and at < packing.LENGTH
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}
    for p in pieces:
        some = np.array(ids[p.doc_id][p.start : p.start + p.length], dtype="<u4")
        assert len(some) == p.length and zlib.crc32(some.tobytes()) == p.ids_crc32


def test_every_token_lies_in_one_piece(make):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice(["alpha", "be", "Gamma,", "été", "x1"]) for _ in range(draw.choice((1, 30, 700))))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "long word " * 30_000), (None, "no name"), (103, rows[0][1])]
    pieces = packing.pack(make(rows, ["curve", "start"]), *packing_files()).collect()
    check(rows, pieces)
    starts = sorted((p.start, p.length) for p in pieces if p.doc_id == 102)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_repeated_rows_and_empty_tables(make):
    pieces = packing.pack(make([(1, "a b"), (1, "a b")]), *packing_files()).collect()
    assert sum(p.length for p in pieces) == 2 * pieces[0].doc_tokens
    assert packing.pack(make([]), *packing_files()).count() == 0


def test_equal_rows_without_id_are_spread(spark, make):
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # as small ranges would be put together
    spark.conf.set(name, "false")
    try:
        rows = packing.pack(make([(None, "the same words")] * 2000).repartition(4), *packing_files()).collect()
    finally:
        spark.conf.unset(name)
    assert sum(p.length for p in rows) == 2000 * rows[0].doc_tokens
    per_range = [len([p for p in rows if p.sequence_id >> 40 == r]) for r in range(8)]
    assert max(per_range) < 700


def test_neighbours_on_the_curve_are_alike(make):
    kinds = [["uno", "dos", "tres"], ["eins", "zwei", "drei"], ["01", "22", "93"]]
    draw = random.Random(2)
    vectors = [packing.hashed_vector(" ".join(draw.choices(kinds[i % 3], k=80))) - 1 / 16 for i in range(90)]
    keys = packing.hilbert_keys(packing.cells_of(np.array(vectors) @ packing.projection()))
    order = [i % 3 for i in np.argsort(keys)]
    assert sum(a != b for a, b in zip(order, order[1:])) < 12
