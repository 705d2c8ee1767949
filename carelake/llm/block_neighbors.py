"""Nearest neighbours by a block matrix join over int8 codes.

Vectors are dealt into blocks of bounded size. A block is packed once: every
vector as int8 codes with its own scale, the length of what the codes leave out
(its quantisation error), and the original numbers. Each block of queries meets
each block of candidates in one row of an equality join, which a task works off
in tiles: the product of two tiles of codes is an integer product (exact in the
float32 unit, as 1,024 products of seven bits stay below 2^24), and with the two
errors it bounds the distance from both sides. Pairs whose lower bound is beyond
the k-th smallest upper bound, or beyond the k-th distance found, are out. What
survives is computed from the original numbers in double precision and enters
the query's heap of k. The heaps of all blocks are merged at the end.

Equal vectors are one candidate that carries the k + 1 smallest of its ids: no
query can return more of them, however many copies there are.

The work is queries times candidates, as the method has it. A candidate block
is shuffled once; query blocks are sent once for each candidate block, so the
traffic falls with the size of the blocks (``BLOCK_VALUES``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import settle, ship_package
from .common import attach_small, in_tasks

K = 10
#: Numbers in a block: 4 MB of codes, 16 MB of floats.
BLOCK_VALUES = 4_000_000
#: Blocks are not made smaller than this for the sake of more tasks.
LEAST_ROWS = 1_024
TILE_QUERIES = 128
TILE_CANDIDATES = 8_192
#: Products of codes summed at a time: 1,024 * 127 * 127 < 2^24.
EXACT_WIDTH = 1_024
LEVELS = 127
#: Share of the vectors' lengths that covers rounding in the bounds themselves.
SLACK = 1e-7

BLOCK = "codes binary, scale binary, error binary, square binary, numbers binary, ids binary, ends binary"
FOUND = "dim int, part int, place int, query_id long, vec_id long, score double"


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, empty or zero, all numbers finite."""
    return F.expr(
        f"""size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))
            AND exists({vector}, x -> x != 0)"""
    )


# --- packing ----------------------------------------------------------------------


def quantised(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and quantisation error of each row of doubles."""
    scale = np.abs(rows).max(axis=1) / LEVELS
    scale = np.where(scale > 0, scale, 1.0)  # numbers too small to divide: all codes 0
    codes = np.clip(np.rint(rows / scale[:, None]), -LEVELS, LEVELS)
    with np.errstate(over="ignore"):
        error = np.sqrt(((rows - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes.astype(np.int8), scale, error * (1 + 1e-12)


def packed(table: pa.Table, kind: type) -> dict[str, bytes]:
    """The columns of BLOCK from rows (vector, ids), in the order of their ids."""
    lists = table["ids"].combine_chunks()
    vectors = table["vector"].combine_chunks()
    numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(table), -1)
    counts = np.asarray(lists.value_lengths(), dtype=np.int64)
    codes, scale, error = quantised(numbers.astype(np.float64))
    return {
        "codes": codes.tobytes(),
        "scale": scale.tobytes(),
        "error": error.tobytes(),
        "square": (codes.astype(np.float64) ** 2).sum(axis=1).tobytes(),
        "numbers": numbers.tobytes(),
        "ids": lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
        "ends": np.cumsum(counts).tobytes(),
    }


class Block:
    """A packed block read back."""

    def __init__(self, row: dict, dim: int, kind: type):
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(-1, dim)
        self.scale = np.frombuffer(row["scale"])
        self.square = np.frombuffer(row["square"])
        with np.errstate(over="ignore"):
            self.length2 = self.scale**2 * self.square
        error = np.frombuffer(row["error"])
        self.error = error + SLACK * (np.sqrt(self.length2) + error)
        self.numbers = np.frombuffer(row["numbers"], kind).reshape(-1, dim)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.frombuffer(row["ends"], np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.scale)


# --- tiles ------------------------------------------------------------------------


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of code rows: whole numbers, exact."""
    parts = [
        a[:, at : at + EXACT_WIDTH].astype(np.float32) @ b[:, at : at + EXACT_WIDTH].astype(np.float32).T
        for at in range(0, a.shape[1], EXACT_WIDTH)
    ]
    return parts[0].astype(np.float64) if len(parts) == 1 else sum(p.astype(np.float64) for p in parts)


def bounds(asked: Block, q: slice, held: Block, c: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of a tile."""
    with np.errstate(over="ignore", invalid="ignore"):
        cross = products(asked.codes[q], held.codes[c]) * (2 * asked.scale[q])[:, None] * held.scale[c]
        near = np.sqrt(np.maximum(asked.length2[q][:, None] + held.length2[c] - cross, 0))
        error = asked.error[q][:, None] + held.error[c]
        return near - error, near + error


def distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distances in double precision, squares added up from left to right."""
    with np.errstate(over="ignore"):
        gap = rows.astype(np.float64) - query.astype(np.float64)
        return np.sqrt(np.cumsum(gap * gap, axis=1)[:, -1])


def offer(heap: list, k: int, own: int | None, found: np.ndarray, held: Block, places: np.ndarray) -> None:
    """Put the nearest of ``places`` into the heap of (-distance, -id)."""
    first = held.ids[held.starts[places]]
    for i in np.lexsort((first, found)):
        if len(heap) == k and (-found[i], -first[i]) <= heap[0]:
            return
        at = places[i]
        for id_ in held.ids[held.starts[at] : held.ends[at]].tolist():
            if id_ == own and found[i] == 0:
                continue
            entry = (-float(found[i]), -id_)
            if len(heap) < k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            else:
                break


def block_nearest(asked: Block, held: Block, k: int, own: bool) -> Iterator[tuple[int, list]]:
    """Place of each query in its block, and its heap over one candidate block."""
    for at in range(0, len(asked), TILE_QUERIES):
        q = slice(at, min(at + TILE_QUERIES, len(asked)))
        heaps: list[list] = [[] for _ in range(q.stop - q.start)]
        worst = np.full(len(heaps), np.inf)
        for start in range(0, len(held), TILE_CANDIDATES):
            c = slice(start, min(start + TILE_CANDIDATES, len(held)))
            lower, upper = bounds(asked, q, held, c)
            limit = worst
            if np.isinf(worst).any() and upper.shape[1] > k:
                # the query's own vector may be among the k + 1 smallest
                reach = np.partition(np.nan_to_num(upper, nan=np.inf), k, axis=1)[:, k]
                limit = np.minimum(worst, reach)
            alive = ~(lower > limit[:, None])
            for i in np.nonzero(alive.any(axis=1))[0]:
                places = start + np.nonzero(alive[i])[0]
                found = distances(asked.numbers[at + i], held.numbers[places])
                mine = int(asked.ids[asked.starts[at + i]]) if own else None
                offer(heaps[i], k, mine, found, held, places)
                if len(heaps[i]) == k:
                    worst[i] = -heaps[i][0][0]
        yield from ((at + i, heap) for i, heap in enumerate(heaps) if heap)


# --- Spark ------------------------------------------------------------------------


def _blocks_of(rows: DataFrame, tasks: int, name: str) -> DataFrame:
    """(dim, blocks): how many blocks the vectors of each length are dealt into."""
    size = F.ceil(F.count(F.lit(1)) * F.first("dim") / F.lit(BLOCK_VALUES))
    spread = F.least(F.lit(tasks), F.ceil(F.count(F.lit(1)) / F.lit(LEAST_ROWS)))
    return rows.groupBy("dim").agg(F.greatest(size, spread).cast("int").alias(name))


def _packed_blocks(rows: DataFrame, kind: type, block: str) -> DataFrame:
    """One row per (dim, ``block``) from rows (dim, block, vector, ids)."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.append_column("first", pa.array([ids[0] for ids in table["ids"].to_pylist()]))
        table = table.sort_by("first").drop_columns(["first"])
        row = {"dim": key[0].as_py(), block: key[1].as_py(), **packed(table, kind)}
        return pa.table(
            {c: pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int32()) for c, v in row.items()}
        )

    rows = rows.select("dim", block, "vector", "ids")
    return rows.groupBy("dim", block).applyInArrow(pack, f"dim int, {block} int, {BLOCK}")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all heaps of a query; a heap per query while its rows pass."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, heap, out = None, [], []

        def closed() -> None:
            ranked = sorted((-d, -i) for d, i in heap)
            out.extend((present[3], rank, i, d) for rank, (d, i) in enumerate(ranked, 1))

        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("dim", "part", "place", "query_id")))
            for key, id_, score in zip(keys, batch["vec_id"].to_pylist(), batch["score"].to_pylist()):
                if key != present:
                    if present is not None:
                        closed()
                    present, heap = key, []
                if len(heap) < k:
                    heapq.heappush(heap, (-score, -id_))
                else:
                    heapq.heappushpop(heap, (-score, -id_))
            yield _ranked(out)
            out.clear()
        if present is not None:
            closed()
            yield _ranked(out)

    key = ["dim", "part", "place"]
    dealt = found.repartition(*key).sortWithinPartitions(*key)
    return in_tasks(dealt, best, "query_id long, rank int, vec_id long, score double")


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"query_id": pa.int64(), "rank": pa.int32(), "vec_id": pa.int64(), "score": pa.float64()}
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    own: bool = True,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k candidates nearest to each query.

    Both tables have a long ``key`` and an array ``vector``; other columns are not
    read. Score is the Euclidean distance in double precision, equal ones rank by
    the smaller id. Fewer than k candidates: all of them. No queries or candidates:
    no rows.

    Rows without id, and vectors that are null, empty, zero, or hold a null, NaN
    or infinite number, take no part. Vectors are compared with those of their own
    length only. Equal rows (id and vector) are one row. Rows that share an id but
    not a vector are different rows, as queries and as candidates. With ``own``, a
    query is the row of that id and vector, which is no candidate for itself.
    Distances beyond the range of doubles are infinite and come last.
    """
    spark = candidates.sparkSession
    ship_package(spark)

    def rows(df: DataFrame) -> DataFrame:
        element = df.schema[vector].dataType.elementType
        numbers = F.col(vector) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>")
        named = df.select(F.col(key).cast("long").alias("id"), numbers.alias("vector"))
        named = named.where(F.col("id").isNotNull() & usable("vector"))
        return named.groupBy("vector", "id").agg(F.size("vector").alias("dim")).select("id", "vector", "dim")

    kind = np.float32 if all(
        isinstance(df.schema[vector].dataType.elementType, T.FloatType) for df in (candidates, queries)
    ) else np.float64
    tasks = max(spark.sparkContext.defaultParallelism, 1)

    # equal vectors become one candidate with its k + 1 smallest ids
    smallest = Window.partitionBy("vector").orderBy("id")
    few = rows(candidates).withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1)
    once = few.groupBy("vector").agg(F.first("dim").alias("dim"), F.sort_array(F.collect_list("id")).alias("ids"))
    once = settle(once)
    asked = settle(rows(queries).select("vector", "dim", F.array("id").alias("ids")))

    blocks = settle(_blocks_of(once, tasks, "blocks"))
    dealt = attach_small(once, blocks, "dim", "inner")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vector"), "blocks").cast("int"))
    held = _packed_blocks(dealt, kind, "block")

    parts = _blocks_of(asked, 1, "parts")
    asked = attach_small(asked, parts, "dim", "inner")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vector", "ids"), "parts").cast("int"))
    # as many as there are candidate blocks of the same length
    sent = attach_small(settle(_packed_blocks(asked, kind, "part")), blocks, "dim", "inner")
    sent = sent.select("dim", "part", F.struct(*[c.split()[0] for c in BLOCK.split(", ")]).alias("asked"),
                       F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))

    # explicit numbers: small blocks are much work, so they aren't to be put together
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks)
    met = sent.repartition(n, "dim", "block").join(held.repartition(n, "dim", "block"), ["dim", "block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                left, right = Block(row["asked"], row["dim"], kind), Block(row, row["dim"], kind)
                out = []
                for place, heap in block_nearest(left, right, k, own):
                    query = int(left.ids[place])
                    out += [(row["dim"], row["part"], place, query, -id_, -d) for d, id_ in heap]
                columns = list(zip(*out)) or [()] * 6
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], [f.split()[0] for f in FOUND.split(", ")]
                )

    found = settle(in_tasks(met.drop("block"), search, FOUND))
    return merged(found, k)


ORACLE = """
WITH rows AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id, sqrt(list_reduce(
    list_transform(range(1, len(q.v) + 1), lambda i: (q.v[i] - c.v[i]) * (q.v[i] - c.v[i])), lambda a, x: a + x)) AS score
  FROM rows AS q JOIN rows AS c ON q.vec_id % 100 = 0 AND len(q.v) = len(c.v) AND (q.vec_id <> c.vec_id OR q.v <> c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id, qv ORDER BY score, vec_id) AS INT) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
