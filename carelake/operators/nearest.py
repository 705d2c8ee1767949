"""Exact top-k by cosine similarity.

No pair of a query and a document ever becomes a row: a task compares a block
of queries with a block of documents and passes on its k best per query.

* Few queries: their matrix goes to every task and the documents stay in place.
* Few documents: the same the other way round, and no shuffle at all.
* Many of both: both sides are dealt into blocks of bounded size, each pair of
  blocks meets in one task, and the k best of every block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import settle, ship_package

BROADCAST_VALUES = 2_000_000  # numbers in a broadcast matrix, 16 MB
BLOCK_VALUES = 2_000_000  # numbers in one side of a block pair, 16 MB
PAIRS_PER_STEP = 1_000_000  # similarities held at once in a task
FOUND_PER_STEP = 200_000  # pairs found beyond the k best, held until they are sorted out
ROWS_PER_STEP = 4_096  # documents compared at once
SCORE_DIGITS = 12  # so that equal vectors tie however they are blocked


def top_k(
    queries: DataFrame,
    documents: DataFrame,
    k: int = 3,
    query_key: str = "query_key",
    document_key: str = "document_key",
    vector: str = "vector",
    broadcast_values: int = BROADCAST_VALUES,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """``query_key, document_key, score, rank`` for the k nearest documents.

    Keys are unique strings or numbers. Equal scores rank by document key.
    """
    ship_package(queries.sparkSession)
    left = settle(_keyed(queries, query_key, vector))
    n_queries, dim = _size(left)
    if n_queries * dim <= broadcast_values:
        near = _scan_documents(left, _keyed(documents, document_key, vector), k)
    else:
        right = settle(_keyed(documents, document_key, vector))
        n_documents, _ = _size(right)
        if n_documents * dim <= broadcast_values:
            near = _scan_queries(left, right, k)
        else:
            rows = max(1, block_values // max(dim, 1))
            near = _block_pairs(
                left, right, k, ceil(n_queries / rows), ceil(n_documents / rows)
            )
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("d"))
    return (
        near.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(
            F.col("q").alias(query_key), F.col("d").alias(document_key), "score", "rank"
        )
    )


def comparable(key: str, vector: str) -> Column:
    """Whether a row can be compared: a vector that is null or empty, or holds a null,
    NaN or infinite number, is nobody's neighbour and finds none."""
    return F.expr(
        f"""{key} IS NOT NULL AND size({vector}) > 0 AND forall({vector}, x ->
           x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"""
    )


def _keyed(df: DataFrame, key: str, vector: str) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    return rows.where(comparable("key", "vector"))


def _size(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    return row.n, row.dim or 0


def _result_schema(queries: DataFrame, documents: DataFrame) -> str:
    q, d = (df.schema["key"].dataType.simpleString() for df in (queries, documents))
    return f"q {q}, d {d}, score double"


def _scan_documents(queries: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    matrix = queries.toPandas()
    shared = queries.sparkSession.sparkContext.broadcast(
        (matrix["key"].to_numpy(), unit_rows(matrix["vector"]))
    )

    def nearest_in_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, vectors = shared.value
        best = Best(len(keys), k)
        for batch in batches:
            if len(batch) and len(keys):
                best.add(vectors, *in_key_order(batch["key"], batch["vector"]))
        if len(found := best.pairs()):
            yield found.assign(q=keys[found["q"]])

    return documents.mapInPandas(
        nearest_in_partition, _result_schema(queries, documents)
    )


def _scan_queries(queries: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    matrix = documents.toPandas()
    shared = queries.sparkSession.sparkContext.broadcast(in_key_order(matrix["key"], matrix["vector"]))

    def nearest_to_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, vectors = shared.value
        for batch in batches:
            if len(batch) and len(keys):
                best = Best(len(batch), k)
                best.add(unit_rows(batch["vector"]), keys, vectors)
                found = best.pairs()
                yield found.assign(q=batch["key"].to_numpy()[found["q"]])

    return queries.mapInPandas(nearest_to_batch, _result_schema(queries, documents))


def _block_pairs(
    queries: DataFrame, documents: DataFrame, k: int, query_blocks: int, document_blocks: int
) -> DataFrame:
    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.select(
            "*",
            F.pmod(F.xxhash64("key"), F.lit(n_own)).alias(own),
            F.explode(F.expr(f"sequence(0L, {n_other - 1}L)")).alias(other),
        )

    left = dealt(queries, "qb", query_blocks, "db", document_blocks)
    right = dealt(documents, "db", document_blocks, "qb", query_blocks)
    return (
        left.groupBy("qb", "db")
        .cogroup(right.groupBy("qb", "db"))
        .applyInArrow(
            lambda left, right: block_result(left, right, k), _result_schema(queries, documents)
        )
    )


def block_result(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """(q, d, score) of the k best rows of one block for each query of another."""
    best = Best(len(left), k)
    others, documents = block_in_key_order(right)
    if len(left) and len(right):
        best.add(unit_matrix(left["vector"]), np.arange(len(others)), documents)
    return named_pairs(best, left["key"].combine_chunks(), others)


def named_pairs(best: Best, keys: pa.Array, others: pa.Array) -> pa.Table:
    """What was found by places, as (q, d, score) by keys."""
    pairs = best.pairs()
    return pa.table(
        {
            "q": keys.take(pa.array(pairs["q"].to_numpy("int64"))),
            "d": others.take(pa.array(pairs["d"].to_numpy("int64"))),
            "score": pa.array(pairs["score"].to_numpy("float64"), pa.float64()),
        }
    )


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """Stack vectors as unit rows; a zero vector stays zero."""
    if not len(vectors):
        return np.zeros((0, 0))
    return _unit(np.stack(vectors.to_numpy()).astype("float64"))


def unit_matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The same of an Arrow column, without an object per row."""
    if not len(vectors):
        return np.zeros((0, 0))
    numbers = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return _unit(numbers.reshape(len(vectors), -1).astype("float64"))


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    rows /= np.where(norms > 0, norms, 1.0)
    return rows


def in_key_order(keys: pd.Series, vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Keys and unit rows by ascending key, as ``Best.add`` takes them."""
    ordered = keys.sort_values()
    return ordered.to_numpy(), unit_rows(vectors.loc[ordered.index])


def block_in_key_order(block: pa.Table) -> tuple[pa.Array, np.ndarray]:
    order = pc.sort_indices(block["key"])
    return block["key"].combine_chunks().take(order), unit_matrix(block["vector"].take(order))


class Best:
    """The k best documents that each of n queries has met, by score and then key.

    What is held is bounded by the queries, not by what they meet: a document that
    doesn't reach a query's k-th best score is left out at once.
    """

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        """``least`` has the score that a document must reach, for each query."""
        self.n, self.k = n, k
        self.least = np.full(n, -np.inf) if least is None else least.copy()
        self._parts: list[pd.DataFrame] = []
        self._held = 0

    def add(
        self, query_rows: np.ndarray, keys: np.ndarray, document_rows: np.ndarray, at: np.ndarray | None = None
    ) -> None:
        """Compare documents, by ascending key, with all queries or those ``at`` these places."""
        at = np.arange(self.n) if at is None else at
        for first in range(0, len(keys), ROWS_PER_STEP):
            some = slice(first, first + ROWS_PER_STEP)
            step = max(1, PAIRS_PER_STEP // len(keys[some]))
            for start in range(0, len(at), step):
                here = at[start : start + step]
                scores = query_rows[here] @ document_rows[some].T
                self._keep(np.round(scores, SCORE_DIGITS, out=scores), here, keys[some])

    def _keep(self, scores: np.ndarray, here: np.ndarray, keys: np.ndarray) -> None:
        for _ in range(min(self.k, len(keys))):
            nth = scores.argmax(axis=1)  # of equal scores the one with the smallest key
            reached = scores[np.arange(len(here)), nth]
            enough = reached >= self.least[here]
            if not enough.all():
                scores, here, nth, reached = scores[enough], here[enough], nth[enough], reached[enough]
            if not len(here):
                return
            self._parts.append(pd.DataFrame({"q": here, "d": keys[nth], "score": reached}))
            self._held += len(here)
            scores[np.arange(len(here)), nth] = -np.inf
        if self._held > 2 * self.k * self.n + FOUND_PER_STEP:
            self.pairs()

    def pairs(self) -> pd.DataFrame:
        """(place of the query, key of the document, score), the k best of each query."""
        if not self._parts:
            return pd.DataFrame({"q": np.zeros(0, "int64"), "d": np.zeros(0, "int64"), "score": np.zeros(0)})
        found = pd.concat(self._parts).sort_values(["q", "score", "d"], ascending=[True, False, True])
        nth = found.groupby("q", sort=False).cumcount().to_numpy()
        last = found[nth == self.k - 1]
        self.least[last["q"].to_numpy()] = last["score"].to_numpy()
        self._parts = [found[nth < self.k]]
        self._held = len(self._parts[0])
        return self._parts[0]
