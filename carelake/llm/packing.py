"""Packing along a space-filling curve.

Each document has a hashed vector of its words' bytes, projected to three
dimensions. Its place on a Hilbert curve through that cube is its sort key, so
neighbours on the curve have similar texts. Documents are range-sorted by the
key, and each range is packed by one pass: tokens go into the present sequence
until it is full, and what is left of a document goes on in the next. The tail
of a range is cut at powers of two, so that no sequence needs padding.

Texts are tokenised after the shuffle, so only text and key move. Words repeat:
tokens of a word with its space before are kept in a bounded table. That is
exact, as pre-tokens of the byte-level model never reach from other characters
over to a following space.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_tasks

LENGTH = 2048
END = 1
DIMENSIONS = 3
#: Bits of each dimension on the curve.
ORDER = 12
VECTOR = 256
#: Words whose tokens a worker remembers; it then forgets all and starts anew.
REMEMBERED = 200_000
SEED = 7
SPECIAL = "<|endoftext|>"


@cache
def projection(size: int = VECTOR, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dimensions)) / np.sqrt(size)


def hashed_vector(text: str | None, size: int = VECTOR) -> np.ndarray:
    """Counts of hashed byte trigrams, as square roots, of length one (or zero)."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    counts = np.zeros(size)
    for at in range(0, max(0, len(raw) - 2), 1 << 20):
        part = raw[at : at + (1 << 20) + 2].astype(np.uint32)
        mixed = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA6B)) ^ (part[2:] * np.uint32(0xC2B2AE35))
        counts += np.bincount((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(24), minlength=size)
    root = np.sqrt(counts)
    norm = np.linalg.norm(root)
    return root / norm if norm else root


def cells_of(points: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Cells of projected points. A projection of unit vectors is spread about
    as the normal distribution; the logistic curve makes it about even."""
    even = 1 / (1 + np.exp(-1.702 * points * np.sqrt(VECTOR)))
    return np.minimum((even * (1 << order)).astype(np.int64), (1 << order) - 1)


def hilbert_keys(cells: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Place of each cell (a row of coordinates) on the Hilbert curve: undo the
    rotations of each level from the top, then read the bits in Gray order."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    for level in range(order - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            high = (x[i] & bit) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(order - 1, 0, -1):
        turn ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(order - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = np.zeros((batch.num_rows, VECTOR))
        for i, text in enumerate(batch["text"]):
            vectors[i] = hashed_vector(text.as_py())
        vectors -= 1 / np.sqrt(VECTOR)  # the mean direction says nothing
        keys = hilbert_keys(cells_of(vectors @ projection()))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text"], batch["row"], pa.array(keys)], ["doc_id", "text", "row", "curve"]
        )


class Following(dict):
    """Tokens of a word with the space before it, as packed ids, kept once made."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        value = self[word] = packed(self.encode(" " + word))
        return value


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens:
    """Token ids of texts as the tokenizer file gives them, word by word."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.following = Following(self.plain.encode_ordinary)

    def ids(self, text: str) -> np.ndarray:
        words = text.split(" ")
        # words that are empty or have white space at an end may share a pre-token
        # with their neighbours, and special strings are one id
        if SPECIAL in text or not all(words) or list(map(str.strip, words)) != words:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        if len(self.following) > REMEMBERED:
            self.following.clear()
        first = packed(self.plain.encode_ordinary(words[0]))
        return np.frombuffer(first + b"".join(map(self.following.__getitem__, words[1:])), dtype="<u4")


@cache
def word_tokens(json_path: str, ranks_path: str, pattern: str) -> WordTokens:
    return WordTokens(json_path, ranks_path, pattern)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def tail_lengths(left: int) -> list[int]:
    """Powers of two, descending, that add up to the tail of a range."""
    return [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


class Packer:
    """Deals token runs into sequences, one after another.

    The pieces of the sequence that is not full wait; at the end they are dealt
    again into sequences whose lengths are powers of two.
    """

    def __init__(self, first_id: int, length: int):
        self.sequence, self.length = first_id, length
        self.waiting: list[tuple] = []  # doc_id, start, ids, doc_tokens
        self.used = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            taken = ids[at : at + self.length - self.used]
            self.waiting.append((doc_id, at, taken, len(ids)))
            at += len(taken)
            self.used += len(taken)
            if self.used == self.length:
                yield from self._sequence(self.waiting)
                self.waiting, self.used = [], 0

    def finish(self) -> Iterator[tuple]:
        parts, room = tail_lengths(self.used), 0
        sequence: list[tuple] = []
        for doc_id, start, ids, total in self.waiting:
            at = 0
            while at < len(ids):
                room = room or parts.pop(0)
                taken = ids[at : at + room]
                sequence.append((doc_id, start + at, taken, total))
                at += len(taken)
                room -= len(taken)
                if not room:
                    yield from self._sequence(sequence)
                    sequence = []
        self.waiting, self.used = [], 0

    def _sequence(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1


def _packed(files: tuple[str, str, str], length: int, schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(*files)
        packer = Packer(TaskContext.get().partitionId() << 40, length)
        rows: list[tuple] = []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.append(tokens.ids(text.as_py() or ""), np.uint32(END)).astype("<u4")
                rows.extend(packer.add(doc_id, ids))
                if len(rows) > 20_000:
                    yield batch_of(rows)
                    rows = []
        rows.extend(packer.finish())
        if rows:
            yield batch_of(rows)

    return run


def pack(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset.

    A document is its ids and the id END; a null or empty text is END alone.
    Sequences have ``length`` tokens, or a smaller power of two at the end of a
    range. Rows without doc_id and repeated rows are packed like any other. Equal
    keys are spread over ranges by a hash of the doc_id and by the rows' places in
    the input, so that neither copies nor repeated rows need meet in one task. An empty table gives no rows. Other columns are ignored.

    The files are those of one byte-level vocabulary, as tokenizer and as ranks
    with its ``pattern``; workers must be able to read them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    keyed = in_tasks(rows, _keyed, "doc_id long, text string, row long, curve long")
    order = ["curve", F.xxhash64("doc_id"), "doc_id", "row"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([(c, pa.int64()) for c in COLUMNS])
    kinds = ", ".join(f"{c} long" for c in COLUMNS)
    return in_tasks(ranged.select("doc_id", "text"), _packed((json_path, ranks_path, pattern), length, schema), kinds)
