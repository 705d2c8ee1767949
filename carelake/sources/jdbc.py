"""Relational sink and source over JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# URL schemes and driver of the patient database.
URL_SCHEMES = ("postgresql://", "postgresql+psycopg://")
DRIVER = "org.postgresql.Driver"


def _after_scheme(database_url: str) -> str:
    for scheme in URL_SCHEMES:
        if database_url.startswith(scheme):
            return database_url[len(scheme) :]
    raise ValueError(f"not a postgresql:// URL: {redact_url(database_url)}")


def jdbc_url(database_url: str) -> str:
    """The JDBC form of a database URL, without its credentials."""
    return f"jdbc:postgresql://{_after_scheme(database_url).rpartition('@')[2]}"


def credentials(database_url: str) -> tuple[str, str]:
    userinfo, at, _ = _after_scheme(database_url).rpartition("@")
    user, colon, password = userinfo.partition(":")
    if not at:
        raise ValueError("database URL has no credentials")
    if not colon:
        raise ValueError("database URL has no password")
    return user, password


def redact_url(url: str) -> str:
    scheme, sep, rest = url.partition("://")
    userinfo, at, host = rest.rpartition("@")
    user, colon, _ = userinfo.partition(":")
    return f"{scheme}{sep}{user}:***{at}{host}" if sep and at and colon else url


def redacted(url: Column) -> Column:
    """``redact_url`` for a column of URLs."""
    return F.regexp_replace(url, r"^([^:]*://[^:@]*):.*@", "$1:***@")


def jdbc_options(database_url: str, table: str) -> dict[str, str]:
    user, password = credentials(database_url)
    return {
        "url": jdbc_url(database_url),
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": DRIVER,
    }


def write_jdbc(
    df: DataFrame,
    table: str,
    database_url: str,
    mode: str = "overwrite",
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Bulk insert; overwrite truncates, so the table keeps its constraints.

    ``connections`` bounds the load on the database, not the size of the data.
    """
    (
        df.write.format("jdbc")
        .options(**jdbc_options(database_url, table))
        .option("truncate", "true")
        .option("numPartitions", str(connections))
        .option("batchsize", str(batch_rows))
        .mode(mode)
        .save()
    )


def read_jdbc(
    spark: SparkSession,
    table: str,
    database_url: str,
    id_bounds: tuple[int, int] | None = None,
    connections: int = 16,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Full scan; with ``id_bounds`` it is split over several connections."""
    reader = (
        spark.read.format("jdbc")
        .options(**jdbc_options(database_url, table))
        .option("fetchsize", str(fetch_rows))
    )
    if id_bounds is not None:
        reader = (
            reader.option("partitionColumn", "id")
            .option("lowerBound", str(id_bounds[0]))
            .option("upperBound", str(id_bounds[1]))
            .option("numPartitions", str(connections))
        )
    return reader.load()
