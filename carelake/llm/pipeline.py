"""The stages of the corpus pipeline, in terms of the operators.

Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..runtime import scratch_path
from . import mixing, packing, simhash, substring, toxicity
from .common import table, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Rows and bytes that pass between the JVM and Python at once. Buffers on both sides
#: keep the size of the largest batch they held, and executors run all stages.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def bound_batches(spark: SparkSession) -> None:
    """Small batches for the stages, unless the session says otherwise. The setting
    stays, as a stage is computed after its function has returned."""
    for name, value in BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def run_stages(spark: SparkSession, sf_dir: str, stages: Sequence[tuple[str, Stage]]) -> DataFrame:
    """Apply the stages one after another; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in stages:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score as toxic go. The classifier learns from the labelled rows
    of ``docs`` outside the held-out fifth."""
    bound_batches(spark)
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays."""
    bound_batches(spark)
    return simhash.one_of_each_group(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word runs that occur elsewhere leave the texts; all rows stay."""
    bound_batches(spark)
    return substring.without_repeats(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows drawn by the raked probabilities of their cells stay."""
    return mixing.select_mixed(docs)


def packing_files() -> tuple[str, str, str]:
    """The byte-level vocabulary as tokenizer and as ranks, and its pattern."""
    from public_tokenizers import PATTERN

    return tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), PATTERN


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, one row each."""
    bound_batches(spark)
    return packing.pack(docs, *packing_files())
