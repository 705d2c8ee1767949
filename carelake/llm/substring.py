"""Removal of repeated word runs by fixed-block anchors.

A window of 35 words that also starts elsewhere is removed, everywhere. Each
window holds exactly one aligned block of 18 words of its own document.

1. Index: the aligned blocks of all documents. Probe: every rolling window of 18
   words. A block is an anchor if its words also start anywhere else.
2. Extension: only the 35-word windows around anchors are compared, by 64-bit
   hashes; those that occur twice join into the maximal repeats.
3. Words covered by repeats go, and the rest is joined.

Both comparisons send hashes packed in binary, dealt to buckets whose number
grows with the text. A task first compares its own windows: of equal ones just
one hash is sent, so that a passage in a third of all documents gives a bucket
one entry for each task that met it. Only entries that a task saw once carry
their place. Anchor hashes are short: a false anchor costs a comparison only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_words, in_tasks, set_apart

WINDOW = 35
#: The longest block of which any window holds a whole aligned one.
BLOCK = (WINDOW + 1) // 2
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes of text for each bucket, about.
BUCKET_BYTES = 24 << 20
#: Windows that a task gathers before it sends them; words whose hashes it keeps.
GATHERED, REMEMBERED = 1_000_000, 200_000


class WordHashes(dict):
    """Hashes of words, kept for words met again."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


class Powers:
    """Powers of BASE and of its inverse modulo 2^64, as many as were needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            steps = np.full(2 * n, BASE, dtype=np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps = np.full(2 * n, INVERSE, dtype=np.uint64)
            steps[0] = 1
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up[:n], self.down[:n]


def rolling(hashes: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, by differences of sums."""
    n = len(hashes)
    if n < size:
        return np.empty(0, dtype=np.uint64)
    up, down = powers.to(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    mixed = (sums[size:] - sums[:-size]) * down[: n - size + 1]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def planes(values: np.ndarray) -> bytes:
    """The bytes of the values, highest first and alike together: it compresses."""
    return values.view(np.uint8).reshape(len(values), -1).T[::-1].tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    rows = np.frombuffer(data, dtype=np.uint8).reshape(size, -1)[::-1].T
    return np.ascontiguousarray(rows).view(kind).reshape(-1)


def runs_of_equal(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(ordered):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return starts, np.diff(np.append(starts, len(ordered)))


def distinct_places(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (key, place) once, sorted: equal rows share their key and all places."""
    order = np.lexsort((at, keys))
    keys, at = keys[order], at[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
    return keys[fresh], at[fresh]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has entries, and their places in their present order."""
    own = bucket_of(hashes, buckets)
    order = np.argsort(own, kind="stable")
    starts, sizes = runs_of_equal(own[order])
    for at, size in zip(starts, sizes):
        some = order[at : at + size]
        yield int(own[some[0]]), some


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


PROBES = pa.schema(
    [("bucket", pa.int32())]
    + [(c, pa.binary()) for c in ("hashes", "block_hashes", "block_keys", "block_at", "hit_keys", "hit_at")]
)


def _probes(buckets: int) -> Callable:
    """Blocks and rolling windows of the documents of a task, packed by bucket."""

    def flush(hashes, keys, at, task):
        order = np.argsort(hashes)
        starts, sizes = runs_of_equal(hashes[order])
        # equal windows of this task: their blocks are anchors
        repeated = np.repeat(sizes > 1, sizes)
        again = order[repeated]
        again = again[at[again] % BLOCK == 0]
        hit_keys, hit_at = distinct_places(keys[again], at[again])
        row = {"bucket": task % buckets, "hit_keys": hit_keys.tobytes(), "hit_at": hit_at.tobytes()}
        yield _batch([row], PROBES)
        first = order[starts]
        alone = sizes == 1
        for bucket, some in by_bucket(hashes[first], buckets):
            low = hashes[first[some]].astype(np.uint32)
            blocks = first[some[alone[some]]]
            blocks = blocks[at[blocks] % BLOCK == 0]
            row = {
                "bucket": bucket,
                "hashes": planes(np.unique(low)),
                "block_hashes": hashes[blocks].astype(np.uint32).tobytes(),
                "block_keys": keys[blocks].tobytes(),
                "block_at": at[blocks].tobytes(),
            }
            yield _batch([row], PROBES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, powers = WordHashes(), Powers()
        hashes, keys, at, held, task = [], [], [], 0, TaskContext.get().partitionId()
        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"]):
                words = byte_words(text.as_py())
                if len(words) < WINDOW:
                    continue
                own = rolling(memo.of(words), BLOCK, powers)
                hashes.append(own)
                keys.append(np.full(len(own), key, dtype=np.int64))
                at.append(np.arange(len(own), dtype=np.uint32))
                held += len(own)
                if held > GATHERED:
                    yield from flush(np.concatenate(hashes), np.concatenate(keys), np.concatenate(at), task)
                    hashes, keys, at, held, task = [], [], [], 0, task + 1
        if held:
            yield from flush(np.concatenate(hashes), np.concatenate(keys), np.concatenate(at), task)

    return run


def _arrays(column: pa.ChunkedArray, kind) -> np.ndarray:
    parts = [np.frombuffer(x, dtype=kind) for x in column.to_pylist() if x]
    return np.concatenate(parts) if parts else np.empty(0, dtype=kind)


PLACES = "target int, keys binary, counts binary, places binary"


def _dealt(keys: np.ndarray, at: np.ndarray, buckets: int) -> pa.Table:
    """Distinct places packed by where their documents are gathered, not a row for each."""
    keys, at = distinct_places(keys, at)
    target = (keys.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(target, kind="stable")
    target, keys, at = target[order], keys[order], at[order].astype(np.uint32)
    rows: dict[str, list] = {"keys": [], "counts": [], "places": []}
    starts, sizes = runs_of_equal(target)
    for start, size in zip(starts, sizes):
        own = keys[start : start + size]
        first, counts = runs_of_equal(own)
        rows["keys"].append(own[first].tobytes())
        rows["counts"].append(counts.astype(np.uint32).tobytes())
        rows["places"].append(at[start : start + size].tobytes())
    columns = {name: pa.array(values, pa.binary()) for name, values in rows.items()}
    return pa.table({"target": pa.array(target[starts], pa.int32()), **columns})


def _gathered(group: pa.Table) -> pa.Table:
    """(key, places) of the documents of a target, each document and place once."""
    keys = np.repeat(_arrays(group["keys"], np.int64), _arrays(group["counts"], np.uint32))
    keys, at = distinct_places(keys, _arrays(group["places"], np.uint32))
    starts, _ = runs_of_equal(keys)
    offsets = np.append(starts, len(keys)).astype(np.int32)
    places = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at.astype(np.int32)))
    return pa.table({"key": pa.array(keys[starts], pa.int64()), "places": places})


def _anchors(buckets: int) -> Callable:
    """Blocks of a bucket whose hash another task's windows have too."""

    def run(group: pa.Table) -> pa.Table:
        parts = [from_planes(x, np.uint32) for x in group["hashes"].to_pylist() if x]
        ordered = np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint32)
        starts, sizes = runs_of_equal(ordered)
        shared = ordered[starts[sizes > 1]]
        hit = np.isin(_arrays(group["block_hashes"], np.uint32), shared)
        keys = [_arrays(group["block_keys"], np.int64)[hit], _arrays(group["hit_keys"], np.int64)]
        at = [_arrays(group["block_at"], np.uint32)[hit], _arrays(group["hit_at"], np.uint32)]
        return _dealt(np.concatenate(keys), np.concatenate(at), buckets)

    return run


WINDOWS = pa.schema(
    [("bucket", pa.int32())]
    + [(c, pa.binary()) for c in ("shared", "hashes", "keys", "counts", "at", "done_keys", "done_at")]
)


def around(anchors: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of the windows that hold an anchor block."""
    starts = (anchors.astype(np.int64)[:, None] - np.arange(WINDOW - BLOCK + 1)[None, :]).ravel()
    return np.unique(starts[(starts >= 0) & (starts <= n_words - WINDOW)])


def _windows(buckets: int) -> Callable:
    """35-word windows around anchors, packed by bucket."""

    def flush(hashes, docs, at, keys, task):
        order = np.argsort(hashes)
        starts, sizes = runs_of_equal(hashes[order])
        repeated = order[np.repeat(sizes > 1, sizes)]
        done_keys, done_at = distinct_places(keys[docs[repeated]], at[repeated])
        row = {"bucket": task % buckets, "done_keys": done_keys.tobytes(), "done_at": done_at.tobytes()}
        yield _batch([row], WINDOWS)
        shared = hashes[order[starts[sizes > 1]]]
        alone = np.sort(order[starts[sizes == 1]])  # by document again
        left = dict(by_bucket(shared, buckets))
        for bucket, some in by_bucket(hashes[alone], buckets):
            mine = alone[some]
            first, counts = runs_of_equal(docs[mine])
            row = {
                "bucket": bucket,
                "shared": shared[left.pop(bucket, [])].tobytes(),
                "hashes": hashes[mine].tobytes(),
                "keys": keys[docs[mine[first]]].tobytes(),
                "counts": counts.astype(np.uint32).tobytes(),
                "at": planes(at[mine]),
            }
            yield _batch([row], WINDOWS)
        for bucket, some in left.items():
            yield _batch([{"bucket": bucket, "shared": shared[some].tobytes()}], WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, powers = WordHashes(), Powers()
        hashes, docs, at, keys, held, task = [], [], [], [], 0, TaskContext.get().partitionId()

        def gathered():
            return np.concatenate(hashes), np.concatenate(docs), np.concatenate(at), np.array(keys, np.int64), task

        for batch in batches:
            for key, text, anchors in zip(batch["key"].to_pylist(), batch["text"], batch["places"]):
                words = byte_words(text.as_py())
                starts = around(anchors.values.to_numpy(), len(words))
                if not len(starts):
                    continue
                hashes.append(rolling(memo.of(words), WINDOW, powers)[starts])
                docs.append(np.full(len(starts), len(keys), dtype=np.uint32))
                at.append(starts.astype(np.uint32))
                keys.append(key)
                held += len(starts)
                if held > GATHERED:
                    yield from flush(*gathered())
                    hashes, docs, at, keys, held, task = [], [], [], [], 0, task + 1
        if held:
            yield from flush(*gathered())

    return run


def _repeats(buckets: int) -> Callable:
    """Windows of a bucket that occur more than once."""

    def run(group: pa.Table) -> pa.Table:
        hashes = _arrays(group["hashes"], np.uint64)
        every = np.sort(np.concatenate([hashes, _arrays(group["shared"], np.uint64)]))
        starts, sizes = runs_of_equal(every)
        found = np.isin(hashes, every[starts[sizes > 1]])
        keys = np.repeat(_arrays(group["keys"], np.int64), _arrays(group["counts"], np.uint32))
        parts = [from_planes(x, np.uint32) for x in group["at"].to_pylist() if x]
        at = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        return _dealt(
            np.concatenate([keys[found], _arrays(group["done_keys"], np.int64)]),
            np.concatenate([at[found], _arrays(group["done_at"], np.uint32)]),
            buckets,
        )

    return run


def covered(starts: np.ndarray, n_words: int) -> np.ndarray:
    """Which words lie in a window that starts at one of these places."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    starts = np.unique(starts)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return np.cumsum(edges)[:n_words] > 0


def split_text(text: str | None, starts: np.ndarray) -> tuple[int, list[bytes]]:
    """Number of words and those that stay."""
    words = byte_words(text)
    if not len(starts):
        return len(words), words
    gone = covered(starts, len(words))
    return len(words), [w for w, g in zip(words, gone.tolist()) if not g]


def with_repeats(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and repeat_starts: the places of the windows that
    occur elsewhere, or null where there are none.

    Rows are known by a hash of doc_id and text. Equal rows share it, and each
    counts as an occurrence. The texts are dealt by that key once; both joins use it.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    keyed = docs.withColumn("repeat_key", F.xxhash64("doc_id", text))
    slim = keyed.select(F.col("repeat_key").alias("key"), text.alias("text"))
    probes = in_tasks(slim, _probes(buckets), _kinds(PROBES))
    anchors = probes.groupBy("bucket").applyInArrow(_anchors(buckets), PLACES)
    anchors = anchors.groupBy("target").applyInArrow(_gathered, "key long, places array<int>")
    # the same columns in both joins, so that their exchange of the texts is one
    rows = keyed.join(anchors.hint("shuffle_hash"), F.col("repeat_key") == F.col("key"))
    rows = rows.select("key", *docs.columns, "places")
    windows = in_tasks(rows, _windows_of(docs, buckets), _kinds(WINDOWS))
    repeats = windows.groupBy("bucket").applyInArrow(_repeats(buckets), PLACES)
    repeats = repeats.groupBy("target").applyInArrow(_gathered, "key long, places array<int>")
    repeats = repeats.withColumnRenamed("places", "repeat_starts")
    return keyed.join(repeats.hint("shuffle_hash"), F.col("repeat_key") == F.col("key"), "left").select(
        *(keyed[c] for c in docs.columns), "repeat_starts"
    )


def _windows_of(docs: DataFrame, buckets: int) -> Callable:
    inner, place = _windows(buckets), docs.columns.index("text") + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slim():
            for batch in batches:
                columns = [batch.column(0), batch.column(place), batch.column(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "text", "places"])

        return inner(slim())

    return run


def _kinds(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, removed, digests = [], [], []
        for text, starts in zip(batch["text"], batch["repeat_starts"]):
            n, kept = split_text(text.as_py(), starts.values.to_numpy() if starts.is_valid else np.empty(0))
            words.append(n)
            removed.append(n - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row.

    Null, empty and blank texts have no words and the digest of nothing. Texts
    under 35 words lose nothing. A repeated row repeats its windows, so both lose
    them. Rows without doc_id are treated alike. Other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_tasks(with_repeats(slim), _digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept words joined by one space as text, and n_chars if
    there is such a column. Texts that lose nothing, and all rows, stay as they are."""
    rows, restored = set_apart(docs, ("doc_id", "text", "n_chars"))
    names, kinds = rows.columns, rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts, lengths = batch.column(at).to_pylist(), []
            for i, starts in enumerate(batch.column(len(names))):
                if starts.is_valid and len(starts):
                    texts[i] = b" ".join(split_text(texts[i], starts.values.to_numpy())[1]).decode()
                    lengths.append(len(texts[i]))
                else:
                    lengths.append(None)
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, batch.column(at).type)
            if "n_chars" in names:
                old = batch.column(names.index("n_chars"))
                new = [o if n is None else n for o, n in zip(old.to_pylist(), lengths)]
                columns[names.index("n_chars")] = pa.array(new, old.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return restored(in_tasks(with_repeats(rows), run, kinds))
