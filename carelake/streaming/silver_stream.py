"""Incremental silver: new bronze files are merged into a bucketed silver table.

The table is partitioned by a hash of the MRN. A batch is cleaned, reduced to the
latest row per MRN and merged bucket by bucket: the row that silver keeps is the
latest of the stored and the new one, so it doesn't matter in which batches rows come,
or whether a batch comes again. Buckets that a batch doesn't touch are neither read
nor written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleanse import bronze_to_silver, latest_per_mrn
from ..runtime import settle
from ..sources.tables import (
    BUCKET,
    DEFAULT_BUCKETS,
    bucket_of,
    create_bucketed,
    read_table,
    store_number,
    stored_number,
    write_buckets,
)
from .bronze_stream import run_counted

LAST_BATCH = "last_batch"


def merge_batch(batch: DataFrame, silver_path: str, batch_id: int | None = None, buckets: int = DEFAULT_BUCKETS) -> int:
    """Merge bronze rows into silver; returns the rows of the buckets written anew.

    The id of the last batch is kept beside the table, once the batch is written: a
    batch with that id or a lower one was merged before and is left out. A batch whose
    write was cut short is merged again, which gives the same rows.
    """
    spark = batch.sparkSession
    last = stored_number(spark, silver_path, LAST_BATCH)
    if batch_id is not None and last is not None and batch_id <= last:
        return 0
    rows = bronze_to_silver(batch)
    create_bucketed(spark, silver_path, rows.schema, buckets)
    buckets = stored_number(spark, silver_path, "buckets")
    fresh = settle(rows.withColumn(BUCKET, bucket_of("mrn", buckets)))
    touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]  # a row per bucket
    written = 0
    if touched:
        stored = read_table(spark, silver_path).where(F.col(BUCKET).isin(touched))
        merged = latest_per_mrn(stored.select(*rows.columns).unionByName(fresh.drop(BUCKET)))
        written = write_buckets(merged.withColumn(BUCKET, bucket_of("mrn", buckets)), silver_path)
    if batch_id is not None:
        store_number(spark, silver_path, LAST_BATCH, batch_id)
    return written


def refresh_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    max_files_per_batch: int = 10_000,
    buckets: int = DEFAULT_BUCKETS,
) -> int:
    """Merge all bronze files that the checkpoint doesn't know, in bounded batches, and
    stop; returns the bronze rows read. Bronze may be fed by a stream or by batches."""
    schema = read_table(spark, bronze_path).schema
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_batch).parquet(bronze_path)
    )
    return run_counted(
        spark,
        lambda: stream.writeStream.foreachBatch(
            lambda batch, batch_id: merge_batch(batch, silver_path, batch_id, buckets) and None
        )
        .option("checkpointLocation", str(checkpoint_path))
        .trigger(availableNow=True)
        .start(),
    )


def read_refreshed(spark: SparkSession, silver_path: str) -> DataFrame:
    """Silver without its layout."""
    return read_table(spark, silver_path).drop(BUCKET)
