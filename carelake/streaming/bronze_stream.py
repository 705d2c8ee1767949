"""Incremental bronze ingest: each file lands once, however often the job runs."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from threading import Event

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.bronze import csv_options, csv_schema, with_lineage
from ..sources.tables import DEFAULT_FORMAT, is_stream_fed, table_exists

#: How long the events of a query that has ended may take to arrive.
EVENTS_SECONDS = 60


def start_incremental_ingest(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    max_files_per_batch: int = 10_000,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Take all files not yet in the checkpoint, in bounded batches, then stop.

    The stream keeps its own list of finished files beside the table and readers
    trust that list alone, so a table is fed by streams or by batches, not both.
    """
    if table_exists(spark, output_path) and not is_stream_fed(spark, output_path):
        raise ValueError(f"{output_path} was written by batch jobs; use another path")
    raw = (
        spark.readStream.schema(csv_schema())
        .options(**csv_options())
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .csv(str(input_path))
    )
    return (
        with_lineage(raw)
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", str(checkpoint_path))
        .trigger(availableNow=True)
        .start(str(output_path))
    )


class _Rows(StreamingQueryListener):
    """Adds up the input rows that one query reports."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


def run_counted(spark: SparkSession, start: Callable[[], StreamingQuery]) -> int:
    """Run a query that stops by itself to its end; returns the rows that its batches
    report to have read."""
    seen = _Rows()
    spark.streams.addListener(seen)
    try:
        query = start()
        query.awaitTermination()
        run = str(query.runId)
        # events arrive in order, the end after all progress
        if not seen.ended[run].wait(EVENTS_SECONDS):
            raise RuntimeError("the query ended, but its progress was not reported")
        return seen.rows.get(run, 0)
    finally:
        spark.streams.removeListener(seen)


def ingest_new_files(
    spark: SparkSession, input_path: str, output_path: str, checkpoint_path: str, **options
) -> int:
    """Run to the end and return the rows added, as the batches report them."""
    return run_counted(
        spark, lambda: start_incremental_ingest(spark, input_path, output_path, checkpoint_path, **options)
    )
