"""Bronze, silver and gold jobs: read a table, transform it, write the next one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleanse import bronze_to_silver
from ..operators.cohorts import ADMISSION_MONTH, with_admission_month
from ..fixed_values import PATIENT_COLUMNS
from ..operators.contract import (
    REASONS,
    broken_rules,
    patient_lineage,
    patient_rules,
    project_patient,
    repeats_mrn,
    split_gold,
    split_stored,
)
from ..operators.ranking import number_by_digest
from ..runtime import counted, scratch_path, settle
from ..schemas import LINEAGE_COLUMNS, STORED_PATIENT_SCHEMA
from ..sources.bronze import read_bronze
from ..sources.jdbc import write_jdbc
from ..sources.tables import (
    DEFAULT_FORMAT,
    read_table,
    save_table,
    store_number,
    stored_number,
    table_exists,
    truncate_table,
)

#: Names of the staged outcomes, and of the number kept beside the patient table.
OUTCOME, ACCEPTED, REJECTED = "outcome", "accepted", "rejected"
HIGH_WATER = "high_water"


@dataclass(frozen=True)
class LayerCounts:
    rows_in: int
    rows_out: int

    @property
    def dropped(self) -> int:
        return self.rows_in - self.rows_out


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    mode: str = "overwrite",
    fmt: str = DEFAULT_FORMAT,
) -> LayerCounts:
    """Both counts come from the writing job.

    The input count is taken below the shuffle and may count a task twice when
    a lost executor makes it run again; the output count is exact.
    """
    bronze, seen = counted(read_bronze(spark, bronze_path, fmt))
    written = save_table(bronze_to_silver(bronze), silver_path, mode, fmt)
    return LayerCounts(rows_in=seen.get["rows"], rows_out=written)


def read_silver(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return read_table(spark, path, fmt)


def reserve_ids(spark: SparkSession, table_path: str, n: int) -> int:
    """First of ``n`` new ids of a table. The highest id ever given is kept beside the
    table, and raised before any row is written: a load that fails leaves a gap, but no
    id is given twice, nor those of deleted rows."""
    used = stored_number(spark, table_path, HIGH_WATER) or 0
    store_number(spark, table_path, HIGH_WATER, used + n)
    return used + 1


def truncate_patients(spark: SparkSession, table_path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Empty a patient table; its ids start at 1 again."""
    truncate_table(spark, table_path, STORED_PATIENT_SCHEMA, fmt)
    store_number(spark, table_path, HIGH_WATER, 0)


def _staged(silver: DataFrame, spark: SparkSession) -> DataFrame:
    """Silver, read once and written by outcome: the rows that keep the rules of the
    patient table, and the others with their reasons. Lineage stays beside them."""
    path = scratch_path(spark, "gold")
    lineage = [c for c in LINEAGE_COLUMNS if c in silver.columns]
    judged = silver.select(*PATIENT_COLUMNS, *lineage, broken_rules(patient_rules()).alias(REASONS))
    outcome = F.when(F.size(REASONS) == 0, ACCEPTED).otherwise(REJECTED)
    judged.withColumn(OUTCOME, outcome).write.partitionBy(OUTCOME).parquet(path)
    return spark.read.schema(f"{_ddl(judged)}, {OUTCOME} string").parquet(path)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    database_url: str | None = None,
    table: str = "patient",
    quarantine_path: str | None = None,
    lineage_path: str | None = None,
    by_month: bool = False,
    mode: str = "overwrite",
    fmt: str = DEFAULT_FORMAT,
) -> int:
    """Load the rows the patient table can hold; returns how many.

    Silver is read once and staged by outcome in the shared scratch folder; what
    follows reads the columns and outcomes it needs from there. Rows get dense ids that
    continue after the highest one the table ever gave (from 1 on overwrite), in digest
    order of their MRN, and the time of the load.

    An MRN that the table has is refused on append: its row goes to quarantine.

    ``by_month`` partitions the files by admission month, which lets the date
    cohorts skip the months they do not ask for.
    The database is touched last, and only by rows that keep its rules, so a bad
    row cannot leave the table truncated. It gives ids of its own.
    """
    if mode == "ignore" and table_exists(spark, gold_path):
        return 0
    staged = _staged(read_silver(spark, silver_path, fmt), spark)
    valid = staged.where(F.col(OUTCOME) == ACCEPTED)
    one = F.lit(1).cast("long").alias("copies")
    invalid = staged.where(F.col(OUTCOME) == REJECTED).select(*PATIENT_COLUMNS, REASONS, one)
    accepted, repeated = split_gold(valid, mrn_is_unique=not repeats_mrn(valid))
    rejected = invalid.unionByName(repeated)
    if mode == "append" and table_exists(spark, gold_path):
        accepted, again = split_stored(accepted, read_table(spark, gold_path, fmt))
        rejected = settle(rejected.unionByName(again))  # before the table has the new rows
    accepted = settle(accepted)
    if mode == "overwrite" or not table_exists(spark, gold_path):
        store_number(spark, gold_path, HIGH_WATER, 0)
    first = reserve_ids(spark, gold_path, accepted.count())
    numbered = number_by_digest(accepted, "mrn", "id", first).withColumn("created_at", F.current_timestamp())
    if by_month:
        numbered = with_admission_month(numbered)
    if quarantine_path is not None:
        save_table(rejected, quarantine_path, mode, fmt)
    if lineage_path is not None:
        save_table(patient_lineage(staged), lineage_path, mode, fmt)
    partitions = [ADMISSION_MONTH] if by_month else []
    written = save_table(numbered, gold_path, mode, fmt, partitions)
    if database_url is not None:
        write_jdbc(project_patient(accepted), table, database_url, mode)
    return written
