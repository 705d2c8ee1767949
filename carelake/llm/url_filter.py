"""URL filters as a temporal join: each capture against the list of its day.

A list is a log of dated entries: from a date on, a key (a host or a parent
domain) is blocked, or allowed again. Entries of a key become intervals that end
where the next entry begins. Each capture gives its host and all parent domains
as keys; each key meets at most one interval that holds the capture's date, which is
looked for among the intervals of the key in that month; the longest key with an
active entry decides.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle

BLOCK, ALLOW = "block", "allow"


#: Longer names are no hosts.
LONGEST_HOST = 253


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null if there is none.
    Blanks and control characters before the address don't count. A numeric address
    in brackets keeps them. A host over 253 characters is none."""
    plain = F.regexp_replace(F.lower(url), r"^[\x00-\x20]+", "")
    place = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^\[/:?#][^/:?#]*)"
    host = F.regexp_replace(F.regexp_extract(plain, place, 1), r"\.+$", "")
    return F.when((host != "") & (F.length(host) <= LONGEST_HOST), host)


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, since, until) of ``entries`` (key string, since date, action).

    until is the day of the key's next entry, excluded, or null: still active. Of
    several entries of a key and day, block wins. Entries with a null key or date,
    or another action than block and allow, are ignored. A key's entries are first
    reduced to one a day, which bounds what one key gathers by its days.
    """
    daily = entries.where(F.col("action").isin(BLOCK, ALLOW) & F.col("key").isNotNull() & F.col("since").isNotNull())
    daily = daily.groupBy(F.lower("key").alias("key"), "since").agg(F.max("action").alias("action"))
    runs = daily.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("since", "action"))).alias("runs"))
    return runs.select("key", F.posexplode("runs").alias("at", "run"), "runs").select(
        "key",
        F.col("run.action").alias("action"),
        F.col("run.since").alias("since"),
        F.get("runs", F.col("at") + 1)["since"].alias("until"),
    )


def by_month(active: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Intervals with each ``month`` that they hold a day of, from ``first`` to ``last``.
    Joined by key and month, a capture meets the intervals of its month alone, 31 at
    most, and the captures of a hot key are spread over the months."""
    if first is None:
        return active.limit(0).withColumn("month", F.col("since"))
    held = active.withColumns(
        {
            "from": F.greatest("since", F.lit(first)),
            "to": F.least(F.coalesce(F.date_sub("until", 1), F.lit(last)), F.lit(last)),
        }
    ).where(F.col("from") <= F.col("to"))
    months = F.sequence(F.trunc("from", "month"), F.trunc("to", "month"), F.expr("interval 1 month"))
    return held.withColumn("month", F.explode(months)).drop("from", "to")


def keys_of(host: Column) -> Column:
    """The host and every parent domain down to the last label, longest first; an
    address in brackets has none."""
    labels = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetched, host, matched, listed_since, action, blocked per capture.

    ``captures`` needs page_id, url and fetched (date). blocked says whether the
    deciding entry blocks. Without an active entry, without a host or with a null
    date a capture is not blocked and the entry's columns are null. Captures are
    first reduced to distinct (host, day) pairs, so a hot host meets its entries
    once a day however many pages it has; verdicts are joined back, where AQE
    splits hot hosts. Repeated rows stay. Other columns are ignored.
    """
    rows = captures.select("page_id", "url", "fetched", host_of(F.col("url")).alias("host"))
    days = settle(rows.where("host is not null and fetched is not null").select("host", "fetched").distinct())
    span = days.agg(F.min("fetched").alias("first"), F.max("fetched").alias("last")).first()  # one row
    active = settle(by_month(intervals(entries), span["first"], span["last"]))
    asked = days.select("host", "fetched", F.trunc("fetched", "month").alias("month"), F.explode(keys_of(F.col("host"))).alias("key"))
    hits = asked.join(active, ["key", "month"]).where("since <= fetched AND (until IS NULL OR fetched < until)")
    best = F.max_by(F.struct(F.col("key").alias("matched"), F.col("since").alias("listed_since"), "action"), F.length("key"))
    verdicts = hits.groupBy("host", "fetched").agg(best.alias("entry")).select("host", "fetched", "entry.*")
    judged = rows.join(verdicts, ["host", "fetched"], "left")
    return judged.select(
        "page_id",
        "url",
        "fetched",
        "host",
        "matched",
        "listed_since",
        "action",
        F.coalesce(F.col("action") == BLOCK, F.lit(False)).alias("blocked"),
    )


FIRST_DAY = "2023-01-01"
DAYS = 730


def digest_number(text: Column) -> Column:
    """A number below 2^28 from the first seven hex digits of a digest."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def day_of(text: Column) -> Column:
    number = digest_number(text) % DAYS
    return F.date_add(F.lit(FIRST_DAY).cast("date"), number.cast("int"))


def dated_captures(pages: DataFrame) -> DataFrame:
    """Captures of the table ``pages``, which has no fetch date: one derived from
    the page's id and address by a digest."""
    key = F.concat_ws("|", F.lit("fetch"), F.col("page_id").cast("string"), F.col("url"))
    return pages.select("page_id", "url", day_of(key).alias("fetched"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts and parent domains that ``pages`` holds.

    A key has up to four entries, each present with probability one half by a
    digest of key and number; even digests block and odd ones allow.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    keys = hosts.select(F.explode(keys_of(F.col("host"))).alias("key")).where("key like '%.%'").distinct()
    drawn = keys.select("key", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("n"))
    name = F.concat_ws("|", F.lit("entry"), "key", F.col("n").cast("string"))
    drawn = drawn.withColumn("drawn", digest_number(name)).where("drawn % 4 < 2")
    action = F.when(F.col("drawn") % 2 == 0, BLOCK).otherwise(ALLOW)
    return drawn.select("key", day_of(F.concat_ws("|", F.lit("day"), name)).alias("since"), action.alias("action"))
