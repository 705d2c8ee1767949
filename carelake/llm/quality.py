"""Quality rules of documents and of the hosts they come from.

Everything is built-in SQL functions. Each text is measured where it is read.
Failures of the base rule are summed per host, and the failure rates of hosts
are shrunk towards each other with a beta prior whose two parameters are fitted
to the rates by moments. A host whose shrunk rate is too high loses all its
documents: they fail with it even if their own text keeps the base rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from .common import attach_small, sql_words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Hosts above this shrunk failure rate are rejected.
MAX_HOST_RATE = 0.5
#: Bounds of the fitted strength of the prior, in documents.
PRIOR_STRENGTH = (2.0, 1000.0)
SYMBOLS = "#*$%&|<>"


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the base figures of each row; null texts have no words.

    Repeated windows are found by sorting (hash of the window, place): equal
    neighbours are repeats. Texts stay in their rows, nothing is exploded.
    """
    words = sql_words(F.col("text"))
    rows = docs.select(
        "doc_id",
        F.col(host).cast("string").alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("words", words)
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id",
        "host",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.array_join("words", "").alias("plain"),
        lines.alias("lines"),
    )
    windows = F.expr(
        f"""CASE WHEN size(words) >= {WINDOW} THEN sort_array(transform(
              sequence(0, size(words) - {WINDOW}),
              i -> named_struct('h', xxhash64(words[i], words[i + 1], words[i + 2]), 'at', i)))
            ELSE cast(array() AS array<struct<h: bigint, at: int>>) END"""
    )
    rows = rows.select(
        "doc_id",
        "host",
        "n_words",
        F.length("plain").cast("long").alias("word_chars"),
        (F.length("plain") - F.length(F.translate("plain", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    repeated = F.expr(
        """filter(windows, (w, i) ->
             (i > 0 AND windows[i - 1].h = w.h)
             OR (i + 1 < size(windows) AND windows[i + 1].h = w.h))"""
    )
    rows = rows.withColumn("repeated", repeated)
    covered = F.expr(
        "size(array_distinct(flatten(transform(repeated, w -> array(w.at, w.at + 1, w.at + 2)))))"
    )
    return rows.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
    )


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def host_verdicts(figures: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, n_docs, n_failed, host_rate, host_rejected) of every host.

    The prior Beta(s * m, s * (1 - m)): m is the mean rate of the hosts, and s
    follows from how much the rates differ beyond what chance explains. With one
    host, or rates that all agree, s takes its upper bound. Rows without a host
    share none: they are not judged.
    """
    hosts = figures.where("host is not null").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("base_failed").alias("n_failed")
    )
    hosts = settle(hosts)
    rate = F.col("n_failed") / F.col("n_docs")
    whole = hosts.agg(
        F.avg(rate).alias("m"),
        F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"),
        F.avg(1 / F.col("n_docs")).alias("share"),
    )
    low, high = PRIOR_STRENGTH
    chance = F.col("m") * (1 - F.col("m")) * F.col("share")
    spread = F.col("v") - chance
    strength = F.when(spread > 0, F.col("m") * (1 - F.col("m")) / spread - 1).otherwise(F.lit(high))
    whole = whole.select("m", F.greatest(F.lit(low), F.least(F.lit(high), strength)).alias("s"))
    prior = whole.first()  # one row
    m, s = prior["m"] or 0.0, prior["s"] or high
    shrunk = (F.col("n_failed") + F.lit(s * m)) / (F.col("n_docs") + F.lit(s))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > max_rate)


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Figures, base_failed, host_rate, host_rejected and kept of every row.

    kept is false if the base rule fails or the host is rejected. Null, empty and
    blank texts fail. Rows without a host are judged by their text alone and have
    a null host_rate. Repeated rows stay and count each. Other columns are ignored.
    """
    figures = settle(measure(docs, host).withColumn("base_failed", base_failed()))
    verdicts = host_verdicts(figures, max_rate).select("host", "host_rate", "host_rejected")
    judged = attach_small(figures, verdicts, "host")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & ~rejected).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "host",
        "host_rate",
    )
