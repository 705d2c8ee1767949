"""File-backed tables: save modes, schema checks, creation and truncation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import counted, settle

SAVE_MODES = ("append", "overwrite", "ignore")
DEFAULT_FORMAT = "parquet"
#: Row groups of the files written here. A row group is read by one task, so a file of
#: any size is dealt to many tasks only if it has many of them.
ROW_GROUP = {"parquet.block.size": 8 * 1024 * 1024}


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def is_stream_fed(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{str(path).rstrip('/')}/_spark_metadata")


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(str(path))


def save_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
) -> int:
    """Write in one pass and return the rows written; ``ignore`` may write none.

    With ``partition_by``, rows are rebalanced first: AQE gathers small partitions
    into full files and splits those that are too large.
    """
    path = str(path)
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, got {mode!r}")
    if mode != "overwrite" and table_exists(df.sparkSession, path):
        if mode == "ignore":
            return 0
        if is_stream_fed(df.sparkSession, path):
            raise ValueError(f"{path} is fed by a stream; batch rows would stay hidden")
        require_same_schema(read_table(df.sparkSession, path, fmt), df, path)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    rows, seen = counted(df)
    rows.write.format(fmt).options(**ROW_GROUP).mode(mode).partitionBy(*partition_by).save(path)
    return seen.get["rows"]


BUCKET = "bucket"
DEFAULT_BUCKETS = 256


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def stored_number(spark: SparkSession, path: str, name: str) -> int | None:
    """A number kept in a folder beside the table, so that overwriting the table keeps it."""
    place = _beside(path, name)
    return read_table(spark, place).first()["value"] if table_exists(spark, place) else None


def _beside(path: str, name: str) -> str:
    return f"{str(path).rstrip('/')}.{name}"


def store_number(spark: SparkSession, path: str, name: str, value: int) -> None:
    row = spark.createDataFrame([(value,)], "value long")
    row.write.mode("overwrite").parquet(_beside(path, name))


def create_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int = DEFAULT_BUCKETS
) -> bool:
    """Create an empty table that ``upsert_bucketed`` can write; true if it was not there.
    An empty file names the columns until the first bucket is written."""
    fields = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if not create_if_absent(spark, path, fields):
        return False
    store_number(spark, path, "buckets", buckets)
    return True


def upsert_bucketed(batch: DataFrame, path: str, key: str) -> int:
    """Put rows with a unique ``key`` in the place of stored rows with that key, or
    beside them; returns the rows written.

    The table is partitioned by a hash of the key. Only the buckets that the batch
    touches are read and written anew, the files of the others stay as they are. A run
    that fails leaves some buckets old and some new; running the same batch again
    completes it.
    """
    spark = batch.sparkSession
    buckets = stored_number(spark, path, "buckets")
    if buckets is None:
        raise ValueError(f"{path} is not a bucketed table")
    batch = settle(batch.withColumn(BUCKET, bucket_of(key, buckets)))
    touched = [r[BUCKET] for r in batch.select(BUCKET).distinct().collect()]  # a row per bucket
    if not touched:
        return 0
    stored = read_table(spark, path)
    require_same_schema(stored, batch, path)
    # buckets are partitions: the others are not read
    stored = stored.select(*batch.columns).where(F.col(BUCKET).isin(touched))
    kept = stored.join(batch.select(BUCKET, key), [BUCKET, key], "left_anti").select(*batch.columns)
    return write_buckets(kept.unionByName(batch), path)


def write_buckets(rows: DataFrame, path: str) -> int:
    """Replace the buckets that ``rows`` name by ``rows``; other buckets stay. The rows
    may come from the table itself: files are replaced when all are written."""
    rows, seen = counted(rows.hint("rebalance", BUCKET))
    written = rows.write.mode("overwrite").options(**ROW_GROUP).option("partitionOverwriteMode", "dynamic")
    written.partitionBy(BUCKET).parquet(str(path))
    return seen.get["rows"]


def require_same_schema(table: DataFrame, batch: DataFrame, path: str) -> None:
    """Parquet takes a drifted append and fails only when read, so check first."""
    have = {f.name: f.dataType for f in table.schema}
    come = {f.name: f.dataType for f in batch.schema}
    drift = [
        f"{name}: table {_type(have, name)}, batch {_type(come, name)}"
        for name in sorted(have.keys() | come.keys())
        if _type(have, name) != _type(come, name)
    ]
    if drift:
        raise ValueError(f"batch does not fit the table at {path}: {'; '.join(drift)}")


def _type(fields: dict[str, T.DataType], name: str) -> str:
    return fields[name].simpleString() if name in fields else "missing"


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = DEFAULT_FORMAT
) -> bool:
    """Create an empty table; true if it was not there yet."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(str(path))
    return True


def truncate_table(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = DEFAULT_FORMAT
) -> None:
    spark.createDataFrame([], schema).write.format(fmt).mode("overwrite").save(
        str(path)
    )


def require_dimension(points: DataFrame, dim: int, column: str = "vector") -> DataFrame:
    """Fail the job on a vector of another size, inside the same pass."""
    size = F.size(column)
    return points.withColumn(
        column,
        F.when(size == dim, F.col(column)).otherwise(
            F.raise_error(
                F.format_string(f"vector of size %d, collection holds {dim}", size)
            )
        ),
    )
