"""Raw CSV files to the bronze table, with lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_RECORD, RAW_SCHEMA
from .tables import DEFAULT_FORMAT, read_table, save_table


#: Codes that look like numbers stay text, so leading zeros are kept.
TEXT_COLUMNS = [f.name for f in RAW_SCHEMA if isinstance(f.dataType, T.StringType)]


def csv_schema() -> T.StructType:
    return T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_RECORD, T.StringType())])


def csv_options() -> dict[str, str]:
    """Malformed lines keep their text; a header in another order fails the read."""
    return {
        "header": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        "enforceSchema": "false",
    }


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV with a header, types inferred; a missing path fails at once."""
    return spark.read.option("header", True).option("inferSchema", True).csv(str(path))


def read_raw_csv(spark: SparkSession, input_path: str, infer: bool = False) -> DataFrame:
    files = f"{input_path}/*.csv"
    if infer:
        inferred = read_csv(spark, files).schema
        fields = [
            T.StructField(f.name, T.StringType() if f.name in TEXT_COLUMNS else f.dataType)
            for f in inferred
        ]
        return spark.read.schema(T.StructType(fields)).option("header", True).csv(files)
    return spark.read.schema(csv_schema()).options(**csv_options()).csv(files)


def with_lineage(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        F.current_timestamp().alias("ingested_at"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def ingest_raw_csv(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    mode: str = "append",
    infer: bool = False,
    fmt: str = DEFAULT_FORMAT,
) -> int:
    """Append every CSV in the folder to bronze; returns the rows written."""
    return save_table(
        with_lineage(read_raw_csv(spark, input_path, infer)), output_path, mode, fmt
    )


def read_bronze(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return read_table(spark, path, fmt)
