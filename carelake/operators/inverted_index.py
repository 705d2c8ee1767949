"""A stored inverted-file index over vectors, probed by partition.

Build: centroids are vectors of a bounded sample, every row is filed under its
nearest centroid, and the rows are written partitioned by list, so a search reads
the files of the lists it probes and no others. Beside them stand the centroids
and each list's size and radius (the largest angle between centroid and member).

Search: a query probes the lists of its nearest centroids and ranks all rows of
these lists exactly. With ``exact``, a second round probes every further list that
may hold a better row: by the triangle inequality on angles, none is nearer to the
query than the centroid's angle less the radius. The result is then that of
comparing with all rows; how many lists it takes depends on how clustered they are.

A query is one row however many lists it probes: it carries them as a bitmap. Few
queries are sent to the rows, which stay where they are read. Many meet them in blocks
of bounded size on both sides: a block holds several lists, or a part of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import settle, ship_package
from ..sources.tables import read_table, save_table, table_exists
from .nearest import (
    BLOCK_VALUES,
    BROADCAST_VALUES,
    PAIRS_PER_STEP,
    SCORE_DIGITS,
    Best,
    block_in_key_order,
    comparable,
    in_key_order,
    named_pairs,
    unit_matrix,
    unit_rows,
)
from .ranking import digest

#: Centroids are at most so many rows of the table, and so many numbers in all.
MAX_LISTS = 4_096
CENTROID_VALUES = 8_000_000
#: What rounding may do to an angle.
ANGLE_SLACK = 1e-6
LIST = "list_no"


def list_count(rows: int, dim: int) -> int:
    """Lists for so many rows: their square root, within the bounds above."""
    return max(1, min(ceil(sqrt(rows)), MAX_LISTS, CENTROID_VALUES // max(dim, 1)))


def build_index(
    vectors: DataFrame, path: str, key: str = "point_id", vector: str = "vector", lists: int | None = None
) -> int:
    """Write an index of the rows of ``vectors`` with all their columns; returns how
    many rows it holds. ``key`` is unique; its digest draws the centroids, so the
    same table always gives the same lists. Rows without key, and vectors that are
    null, empty or not finite, are not indexed. All vectors have one length, or the
    job fails. An index that stands at ``path`` is replaced."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.where(comparable(key, vector))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("dim")).first()
    wanted = lists or list_count(size.n, size.dim or 0)
    drawn = rows.select(F.col(vector).cast("array<double>").alias("vector"), digest(key).alias("draw"), F.col(key).alias("key"))
    sample = drawn.orderBy("draw", "key").limit(wanted).toPandas()  # bounded by MAX_LISTS
    centroids = unit_rows(sample["vector"])
    spark.createDataFrame(
        [(i, c.tolist()) for i, c in enumerate(centroids)], f"{LIST} int, vector array<double>"
    ).write.mode("overwrite").parquet(f"{path}/centroids")

    shared = spark.sparkContext.broadcast(centroids)
    schema = T.StructType([*rows.schema.fields, T.StructField(LIST, T.IntegerType()), T.StructField("_angle", T.DoubleType())])

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                placed = [
                    # the smallest list of equally near ones
                    (near.argmax(axis=1), near.max(axis=1))
                    for near in _near(unit_rows(batch[vector]), shared.value)
                ]
                first, score = (np.concatenate(part) for part in zip(*placed))
                yield batch.assign(**{LIST: first.astype("int32"), "_angle": np.arccos(np.clip(score, -1, 1))})

    members = rows.mapInPandas(filed, schema)
    written = save_table(members, f"{path}/members", "overwrite", partition_by=[LIST])
    # the columns, for an index without rows, which has no files
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/shape")
    stored = _members(spark, path)
    stored.groupBy(LIST).agg(F.count(F.lit(1)).alias("n"), F.max("_angle").alias("radius")).write.mode(
        "overwrite"
    ).parquet(f"{path}/lists")
    return written


def _near(rows: np.ndarray, centroids: np.ndarray) -> Iterator[np.ndarray]:
    """Similarities with all centroids, a bounded number of them at once."""
    step = max(1, PAIRS_PER_STEP // len(centroids))
    for at in range(0, len(rows), step):
        yield np.round(rows[at : at + step] @ centroids.T, SCORE_DIGITS)


def _members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(read_table(spark, f"{path}/shape").schema).parquet(f"{path}/members")


class InvertedIndex:
    """A stored index; what is kept here is one row per list."""

    def __init__(self, spark: SparkSession, path: str, key: str = "point_id", vector: str = "vector"):
        if not table_exists(spark, f"{path}/lists"):
            raise FileNotFoundError(f"no index at {path}; build one first")
        ship_package(spark)
        self.spark, self.key, self.vector = spark, key, vector
        self._members = _members(spark, path)
        rows = read_table(spark, f"{path}/centroids").orderBy(LIST).toPandas()
        self.centroids = unit_rows(rows["vector"])
        self.sizes = {r[LIST]: (r["n"], r["radius"]) for r in read_table(spark, f"{path}/lists").collect()}

    @property
    def members(self) -> DataFrame:
        """The indexed rows as they were given."""
        return self._members.drop("_angle", LIST)

    def default_probes(self) -> int:
        return max(1, ceil(len(self.centroids) / 8))

    def search(
        self,
        queries: DataFrame,
        k: int = 3,
        probes: int | None = None,
        exact: bool = False,
        query_key: str = "query_key",
        document_key: str = "document_key",
        vector: str = "vector",
        broadcast_values: int = BROADCAST_VALUES,
        block_values: int = BLOCK_VALUES,
    ) -> DataFrame:
        """``query_key, document_key, score, rank`` of the k best rows in the probed
        lists, by cosine; equal scores rank by document key. Query keys are unique.
        Queries whose vector is null, not finite or of another length than the indexed
        ones find nothing."""
        same_length = F.size(vector) == self.centroids.shape[1]
        asked = queries.where(comparable(query_key, vector) & same_length)
        asked = settle(asked.select(F.col(query_key).alias("key"), F.col(vector).alias("vector")))
        probes = min(probes or self.default_probes(), len(self.centroids))
        limits = (broadcast_values, block_values)
        found = settle(_best(self._compare(self._probe(asked, probes), k, *limits), k))
        if exact:
            reached = found.groupBy("q").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
            further = asked.join(reached.withColumnRenamed("q", "key"), "key", "left")
            more = self._compare(self._probe(further, probes, further_on=True), k, *limits)
            found = _best(found.drop("rank").unionByName(more), k)
        return found.select(F.col("q").alias(query_key), F.col("d").alias(document_key), "score", "rank")

    def _probe(self, asked: DataFrame, probes: int, further_on: bool = False) -> DataFrame:
        """(key, vector, least, lists): a bitmap of the nearest lists; with ``further_on``
        of those beyond them that may hold a row as good as ``least``. Queries that
        probe no list are left out."""
        shared = self.spark.sparkContext.broadcast(
            (self.centroids, np.array([self.sizes.get(i, (0, -1.0))[1] for i in range(len(self.centroids))]))
        )
        if not further_on:
            asked = asked.withColumn("least", F.lit(None).cast("double"))

        def near_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            centroids, radius = shared.value
            for batch in batches:
                at, least = 0, batch["least"].fillna(-2.0).to_numpy()
                for near in _near(unit_rows(batch["vector"]), centroids) if len(batch) else ():
                    here = slice(at, at + len(near))
                    at += len(near)
                    order = np.argsort(-near, axis=1, kind="stable")
                    probed = np.zeros(near.shape, bool)
                    np.put_along_axis(probed, order[:, :probes], True, axis=1)
                    if further_on:
                        gap = np.arccos(np.clip(near, -1, 1)) - radius - ANGLE_SLACK
                        best = np.cos(np.clip(gap, 0, np.pi))
                        probed = ~probed & (best >= least[here, None])
                    probed &= radius >= 0
                    bits = [row.tobytes() for row in np.packbits(probed, axis=1)]
                    yield batch[here].assign(lists=bits)[probed.any(axis=1)]

        schema = T.StructType([*asked.schema.fields, T.StructField("lists", T.BinaryType())])
        return settle(asked.mapInPandas(near_lists, schema))

    def _compare(self, probed: DataFrame, k: int, broadcast_values: int, block_values: int) -> DataFrame:
        """(q, d, score): of each task the k best rows that each query meets there."""
        n, dim = probed.count(), self.centroids.shape[1]
        held = self._members.select(F.col(self.key).alias("key"), F.col(self.vector).alias("vector"), LIST)
        if n * dim <= broadcast_values:
            return self._scan(probed, held, k)
        return self._dealt(probed, held, n, k, block_values)

    def _scan(self, probed: DataFrame, held: DataFrame, k: int) -> DataFrame:
        """Rows stay where they are; the queries were measured to be few."""
        rows = probed.toPandas()
        keys, lists = rows["key"].to_numpy(), _bitmaps(rows["lists"], len(self.centroids))
        least = rows["least"].fillna(-np.inf).to_numpy()
        shared = self.spark.sparkContext.broadcast((keys, unit_rows(rows["vector"]), lists, least))
        schema = _result(probed, held)
        # the lists are partitions: only their files are read
        wanted = [int(no) for no in np.nonzero(np.unpackbits(np.bitwise_or.reduce(lists, axis=0)))[0]] if len(keys) else []
        held = held.where(F.col(LIST).isin(wanted) if wanted else F.lit(False))

        def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys, vectors, lists, least = shared.value
            best = Best(len(keys), k, least)
            for batch in batches:
                for no, part in batch.groupby(LIST):
                    best.add(vectors, *in_key_order(part["key"], part["vector"]), at=_that_probe(lists, no))
            if len(found := best.pairs()):
                yield found.assign(q=keys[found["q"]])

        return held.mapInPandas(nearest, schema)

    def _blocks(self, block_values: int) -> dict[int, tuple[int, int]]:
        """Of each list its first block and the number of its blocks: small lists share
        one, large ones have several."""
        rows = max(1, block_values // max(self.centroids.shape[1], 1))
        blocks, at, filled = {}, -1, rows
        for no in sorted(self.sizes):
            n = self.sizes[no][0]
            if n > rows:
                parts = ceil(n / rows)
                blocks[no] = (at + 1, parts)
                at, filled = at + parts, rows
                continue
            if filled + n > rows:
                at, filled = at + 1, 0
            blocks[no] = (at, 1)
            filled += n
        return blocks

    def _dealt(self, probed: DataFrame, held: DataFrame, n: int, k: int, block_values: int) -> DataFrame:
        """Blocks of queries meet the blocks of rows that hold a list they probe."""
        blocks = self._blocks(block_values)
        n_kept = 1 + max(first + parts - 1 for first, parts in blocks.values())
        within = np.zeros((len(self.centroids), n_kept), "float32")
        for no, (first, parts) in blocks.items():
            within[no, first : first + parts] = 1
        n_lists, dim = within.shape[0], self.centroids.shape[1]
        tasks = self.spark.sparkContext.defaultParallelism
        n_asked = max(ceil(n * dim / block_values), ceil(tasks / n_kept))
        shared = self.spark.sparkContext.broadcast(within)

        def with_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    bits = np.unpackbits(_bitmaps(batch["lists"], n_lists), axis=1, count=n_lists)
                    meets = bits.astype("float32") @ shared.value > 0
                    yield batch.assign(kept=[np.nonzero(row)[0].astype("int32") for row in meets])

        schema = T.StructType([*probed.schema.fields, T.StructField("kept", T.ArrayType(T.IntegerType()))])
        asked = probed.mapInPandas(with_blocks, schema).withColumns(
            {"kept": F.explode("kept"), "asked": F.pmod(F.xxhash64("key"), F.lit(n_asked)).cast("int")}
        )
        known = F.broadcast(
            self.spark.createDataFrame([(no, *b) for no, b in blocks.items()], f"{LIST} int, first int, parts int")
        )
        members = held.join(known, LIST).select(
            *held.columns,
            (F.col("first") + F.pmod(F.xxhash64("key"), F.col("parts"))).cast("int").alias("kept"),
            F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))).alias("asked"),
        )

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            least = left["least"].fill_null(-np.inf).to_numpy()
            best = Best(len(left), k, least)
            others, rows = block_in_key_order(right)
            if len(left) and len(right):
                queries, lists = unit_matrix(left["vector"]), _bitmaps(left["lists"].to_pandas(), n_lists)
                home = right[LIST].take(pc.sort_indices(right["key"])).to_numpy()
                for no in np.unique(home):
                    own = np.nonzero(home == no)[0]
                    best.add(queries, own, rows[own], at=_that_probe(lists, no))
            return named_pairs(best, left["key"].combine_chunks(), others)

        place = ["asked", "kept"]
        return asked.groupBy(*place).cogroup(members.groupBy(*place)).applyInArrow(meet, _result(probed, held))


def _bitmaps(lists: pd.Series, n_lists: int) -> np.ndarray:
    """A row of bytes per query."""
    return np.frombuffer(b"".join(lists), "uint8").reshape(len(lists), ceil(n_lists / 8))


def _that_probe(lists: np.ndarray, no: int) -> np.ndarray:
    """Places of the queries whose bitmap names a list."""
    return np.nonzero(lists[:, no // 8] >> (7 - no % 8) & 1)[0]


def _result(queries: DataFrame, rows: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("q", queries.schema["key"].dataType),
            T.StructField("d", rows.schema["key"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("d"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, query_key: str = "query_key", document_key: str = "document_key") -> DataFrame:
    """One row: pairs of the exact result, how many of them were found, and their share."""
    keys = [query_key, document_key]
    hit = found.select(*keys, F.lit(True).alias("hit"))
    return exact.join(hit, keys, "left").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("hit").alias("n_found"),
        F.coalesce(F.try_divide(F.count("hit"), F.count(F.lit(1))), F.lit(1.0)).alias("recall"),
    )
