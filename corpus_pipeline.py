"""The corpus pipeline: stages that turn ``documents`` into packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm.pipeline import (
    mixing_stage,
    packing_stage,
    run_stages,
    simhash_stage,
    substring_stage,
    toxicity_stage,
)

#: Each takes (spark, docs, sf_dir); its result is written and read again.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("substring", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The stages score, hash and tokenise texts in ways that SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that every stage kept."""
    return run_stages(spark, sf_dir, STAGES)
