"""Inserts, deletes and upserts as new table contents.

Each function returns the rows to write; a table is replaced by writing a new
snapshot, never by changing the one being read. The key side of each join is a
single column, which Spark broadcasts when its size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import PATIENT_COLUMNS
from ..runtime import settle
from .contract import REASONS, patient_rules, split_by_rules
from .dedupe import keep_first, keep_latest
from .key_filter import MAX_BITS, KeyFilter
from .lookup import BROADCAST_BYTES, broadcast_if_small
from .ranking import number_by_digest

KEYS_IN_MESSAGE = 20


def stored_mrns(
    existing: DataFrame, mrns: DataFrame, limit: int = BROADCAST_BYTES, max_bits: int = MAX_BITS
) -> DataFrame:
    """Those of the distinct ``mrns`` that the table holds.

    MRNs of a batch that measure less than ``limit`` go to the table, whose rows then
    stay where they are. More of them make a Bloom filter, so that of the table only
    the rows that pass it are shuffled to the exact comparison. Beyond the largest
    filter both sides are shuffled.
    """
    stored = existing.select("mrn")
    sent = broadcast_if_small(mrns, limit)
    if sent is mrns and (passed := KeyFilter.of(mrns, "mrn", max_bits)):
        stored = passed.keep(stored, "mrn")
    return stored.join(sent, "mrn", "left_semi").distinct()


def duplicate_mrns(
    existing: DataFrame, batch: DataFrame, limit: int = BROADCAST_BYTES, max_bits: int = MAX_BITS
) -> DataFrame:
    """MRNs a batch repeats, or that the table holds already."""
    counts = settle(batch.groupBy("mrn").agg(F.count(F.lit(1)).alias("n")))
    repeated = counts.filter(F.col("n") > 1).select("mrn")
    known = stored_mrns(existing, counts.select("mrn"), limit, max_bits)
    return repeated.unionByName(known).distinct()


def new_patients(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows whose MRN is not in the table, one per MRN."""
    once = keep_latest(batch.select(*PATIENT_COLUMNS), ["mrn"], ["admission_date"])
    known = settle(stored_mrns(existing, settle(batch.select("mrn").distinct())))
    return once.join(broadcast_if_small(known), "mrn", "left_anti")


def with_ids(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Ids that continue after the highest one in use, and the insert time."""
    start = F.lit(1)
    if existing is not None:
        top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
        start = top.scalar() + 1
    return number_by_digest(rows, "mrn", "id", start).withColumn(
        "created_at", F.current_timestamp()
    )


def insert_patients(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored form of a batch; fails if a row breaks a rule of the table or an
    MRN is not unique. The batch is computed once."""
    batch = settle(batch.select(*PATIENT_COLUMNS))
    broken = split_by_rules(batch, patient_rules())[1]
    reasons = broken.select(F.explode(REASONS).alias("reason")).groupBy("reason").count()
    if found := reasons.orderBy("reason").collect():  # a row per rule at most
        listed = ", ".join(f"{r['reason']} {r['count']}" for r in found)
        raise ValueError(f"rows break the rules of the table: {listed}")
    taken = settle(duplicate_mrns(existing, batch))
    if total := taken.count():
        shown = ", ".join(r.mrn for r in taken.orderBy("mrn").take(KEYS_IN_MESSAGE))
        more = f" and {total - KEYS_IN_MESSAGE} more, see duplicate_mrns" if total > KEYS_IN_MESSAGE else ""
        raise ValueError(f"duplicate mrn: {shown}{more}")
    return with_ids(existing, batch)


def delete_by_ids(patients: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows that remain."""
    return patients.join(ids.select("id"), "id", "left_anti")


def count_deleted(patients: DataFrame, ids: DataFrame) -> int:
    return patients.join(ids.select("id"), "id", "left_semi").count()


def new_articles(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Found articles whose PMID has not been collected yet."""
    return found.join(existing.select("pmid"), "pmid", "left_anti")


def replace_rows(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Table after a batch with unique keys took the place of stored rows.

    Stored rows stay where they are unless the batch has too many keys to
    broadcast.
    """
    kept = existing.join(batch.select(key), key, "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


def upsert(existing: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """``replace_rows`` for a batch that may repeat keys: the highest ``order`` wins.

    ``order`` should not repeat within a key, else either row may stay.
    """
    last = keep_first(batch, [key], [F.col(order).desc()]).drop(order)
    return replace_rows(existing, last, key)
