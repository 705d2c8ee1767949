"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A fingerprint has 64 bits in three segments of 22, 21 and 21 bits. The Golay
code (23, 12, 7) is perfect: each 23-bit word lies within three bits of just one
codeword. Two words one bit apart therefore share a codeword index if one of
them is decoded as it is and the other with every single bit flipped; that gives
a word six indices at most.

At most three differing bits leave, by pigeonhole, either a segment without
errors beside another with at most one, or one error in each segment. Keys:

* for each ordered pair of segments: the first as it is, an index of the other;
* an index of the first segment with the plain indices of the others, and the
  plain index of the first with any indices of the others.

Keys have 33 to 36 bits, so unrelated fingerprints rarely meet. Fingerprints
that share a key are compared bit by bit, and only true links count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..runtime import settle
from .common import BROADCAST_BYTES, in_tasks, set_apart
from .components import connected_components

SHINGLE = 3
SEED = 42
MAX_DIFFERENT = 3
#: (lowest bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Members of a key that are compared in one go; a larger key is split in blocks.
BLOCK = 1024
#: Generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the Golay code.
GENERATOR = 0b110001110101


@cache
def _error_of_syndrome() -> np.ndarray:
    """The only error of three bits or fewer behind each syndrome."""
    flips = [1 << i for i in range(23)]
    errors = {0}
    for _ in range(3):
        errors |= {e | f for e in errors for f in flips}
    table = np.zeros(2048, dtype=np.uint32)
    for error in errors:
        table[_remainder(error)] = error
    return table


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@cache
def _syndrome_parts() -> tuple[np.ndarray, np.ndarray]:
    low = np.array([_remainder(i) for i in range(4096)], dtype=np.uint32)
    high = np.array([_remainder(i << 12) for i in range(2048)], dtype=np.uint32)
    return low, high


def golay_index(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit word."""
    low, high = _syndrome_parts()
    syndrome = low[words & 4095] ^ high[words >> 12]
    return (words ^ _error_of_syndrome()[syndrome]) >> 11


def nearby_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices reached from each word with no or one bit flipped:
    a row of ``bits + 1`` per word, and which of them count."""
    flips = np.array([0] + [1 << i for i in range(bits)], dtype=np.uint32)
    found = np.sort(golay_index(words[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(found.shape, dtype=bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, first


def _near(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    found, first = nearby_indices(words, bits)
    row, column = np.nonzero(first)
    return row, found[row, column].astype(np.int64)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every fingerprint; ``prints`` are unsigned 64-bit."""
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.uint32) for at, n in SEGMENTS]
    plain = [golay_index(p).astype(np.int64) for p in parts]
    near = [_near(p, n) for p, (_, n) in zip(parts, SEGMENTS)]
    rows, keys = [], []
    for kind, (exact, fuzzy) in enumerate(permutations(range(3), 2)):
        row, index = near[fuzzy]
        rows.append(row)
        keys.append((kind << 40) | (parts[exact][row].astype(np.int64) << 12) | index)
    row, index = near[0]
    rows.append(row)
    keys.append((6 << 40) | (index << 24) | (plain[1][row] << 12) | plain[2][row])
    # pairs of near indices of the second and third segment of the same row
    (row1, index1), (row2, index2) = near[1], near[2]
    count = np.bincount(row2, minlength=len(prints))
    start = np.cumsum(count) - count
    times = count[row1]
    left = np.repeat(np.arange(len(row1)), times)
    within = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
    row = row1[left]
    right = start[row] + within
    key = (6 << 40) | (plain[0][row] << 24) | (index1[left] << 12) | index2[right]
    fresh = (index1[left] != plain[1][row]) | (index2[right] != plain[2][row])
    rows.append(row[fresh])
    keys.append(key[fresh])
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: str | None) -> int:
    """Majority bits over the shingle hashes, repeats included; as a signed long."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t.as_py()) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row_key"], pa.array(prints, pa.int64())], ["doc_id", "row_key", "print"]
        )


def row_key() -> Column:
    """What rows are known by: a hash of doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, print) of each row; a null text is an empty one."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), F.col("text").cast("string").alias("text")
    )
    return in_tasks(rows, _prints, "doc_id long, row_key long, print long")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch["print"].to_numpy()
        for at in range(0, len(prints), 4096):
            some = prints[at : at + 4096]
            row, key = fuzzy_keys(some.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row])], ["key", "print"])


def star_links(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links within a block that connect all that its links connect.

    Breadth first: what was reached is not compared again, so a dense group
    gives one link per member, not all pairs.
    """
    a, b = [], []
    left = prints
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            hit = np.bitwise_count(left ^ x) <= MAX_DIFFERENT
            if hit.any():
                found, left = left[hit], left[~hit]
                a.append(np.full(len(found), x))
                b.append(found)
                reached.extend(found)
    return a, b


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; the last group of a batch waits for the next."""
    kept = [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]

    def links(columns):
        group = np.stack(columns[:3])
        cut = np.flatnonzero((group[:, 1:] != group[:, :-1]).any(axis=0)) + 1
        starts = np.concatenate([[0], cut])
        sizes = np.diff(np.concatenate([starts, [len(columns[3])]]))
        prints = columns[3]
        two = starts[sizes == 2]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= MAX_DIFFERENT
        a, b = [prints[two][near]], [prints[two + 1][near]]
        for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
            more_a, more_b = star_links(prints[at : at + size])
            a += more_a
            b += more_b
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    for batch in batches:
        new = [batch[c].to_numpy() for c in ("key", "i", "j")] + [batch["print"].to_numpy().view(np.uint64)]
        rows = [np.concatenate(pair) for pair in zip(kept, new)]
        if not len(rows[3]):
            continue
        same = np.logical_and.reduce([c == c[-1] for c in rows[:3]])
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        kept = [c[cut:] for c in rows]
        if cut:
            yield links([c[:cut] for c in rows])
    if len(kept[3]):
        yield links(kept)


def fingerprint_links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect what fingerprints at most three bits apart connect.

    ``prints`` holds distinct fingerprints. Keys with one member go after a
    partial count. The members of a key are dealt into blocks by hash, and pairs
    of blocks are compared in tasks of bounded size.
    """
    keys = in_tasks(prints.select("print"), _keys, "key long, print long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = shared.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    members = keys.join(shared, "key")
    members = members.select(
        "key",
        "print",
        F.pmod(F.xxhash64("print"), "blocks").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    members = members.select(
        "key",
        F.least("own", F.col("other").cast("long")).alias("i"),
        F.greatest("own", F.col("other").cast("long")).alias("j"),
        "print",
    )
    dealt = members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "print")
    return in_tasks(dealt, _links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, fingerprint (16 hex digits), component_id, group_print per row.

    ``docs`` needs doc_id and text; other columns are ignored. Null, empty and
    blank texts have the fingerprint zero and are one group. component_id is the
    smallest doc_id reachable; rows without doc_id take part but are no one's
    component_id (null if no member has an id). group_print names the group also
    then. Repeated rows stay repeated. An empty table gives no rows.
    """
    prints = settle(fingerprints(docs))
    distinct = settle(prints.groupBy("print").agg(F.min("doc_id").alias("first")))
    labels = connected_components(fingerprint_links(distinct))
    groups = distinct.join(labels, distinct["print"] == labels["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("group_print")
    )
    groups = settle(groups)
    ids = groups.groupBy("group_print").agg(F.min("first").alias("component_id"))
    groups = groups.join(ids, "group_print").select("print", "component_id", "group_print")
    return prints.join(groups, "print").select(
        "doc_id",
        "row_key",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "group_print",
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that stand for their near-duplicate group.

    Of each group the row with the smallest doc_id stays (one without doc_id only
    if no member has one), once: equal rows stay once. Of several texts with that
    doc_id in one group one stays.
    """
    groups = settle(near_duplicates(docs).select("doc_id", "row_key", "group_print"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key"))
    kept = groups.groupBy("group_print").agg(best["row_key"].alias("row_key")).select("row_key")
    kept = settle(kept)
    counts = groups.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"))
    gone = counts.join(kept, "row_key", "left_anti").select(F.col("row_key").alias("gone_key"))
    again = settle(counts.where("n > 1").join(kept, "row_key", "left_semi"))
    rows, restored = set_apart(docs, ("doc_id", "text"))
    rows = rows.withColumn("row_key", row_key())
    gone = broadcast_if_small(settle(gone), BROADCAST_BYTES)
    left = rows.join(gone, F.col("row_key") == F.col("gone_key"), "left_anti")
    if not again.isEmpty():
        equal = left.join(again.select("row_key"), "row_key", "left_semi").dropDuplicates(["row_key"])
        left = left.join(again.select("row_key"), "row_key", "left_anti").unionByName(equal)
    return restored(left)
