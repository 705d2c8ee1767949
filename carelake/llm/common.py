"""Helpers of the corpus operators: tables, words, texts in tasks, kept rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..runtime import settle, ship_package

#: What separates words: space and the control characters from tab to return.
SPACE = r"[\x20\x09-\x0D]+"
#: Lookup tables are broadcast only when they measure less than this.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    from public_tokenizers import path

    return path(name)


def byte_words(text: str | None) -> list[bytes]:
    """Words in UTF-8. ``bytes.split`` splits at exactly the characters of SPACE."""
    return text.encode().split() if text else []


def sql_words(text: Column) -> Column:
    """Words as an array of strings; none for null and blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def set_apart(docs: DataFrame, known: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but the known ones under plain new names, so that
    none clashes with an operator's own, and a function that gives the old ones back."""
    old = docs.columns
    new = [c if c in known else f"extra_{i}" for i, c in enumerate(old)]
    return docs.toDF(*new), lambda df: df.select(*(F.col(n).alias(o) for n, o in zip(new, old)))


def in_tasks(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package present in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(rows, schema)


def attach_small(rows: DataFrame, lookup: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join a table with unique keys: broadcast if it measures small, else a
    shuffle whose hot partitions AQE splits."""
    return rows.join(broadcast_if_small(settle(lookup), BROADCAST_BYTES), on, how)


#: A DuckDB table of one row, whose list ``t`` holds the checksum of each byte.
CRC_TABLE_SQL = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS bytes(i)
  )
)"""


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a string's bytes in DuckDB, beside CRC_TABLE_SQL."""
    code = f"('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT"
    codes = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {code})"
    step = "xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {step}), 4294967295)"
