"""Language of web pages by fusing what text, markup, address and host say.

1. A naive Bayes model over character n-grams of texts whose language is known
   gives each page's text likelihoods. N-grams of a text depend on each other, so
   its evidence is scaled down.
2. Grouped sums of the text posteriors say how often each language goes with a
   declared markup language, and with an address suffix.
3. The same sums by host, smoothed towards those of the host's domain, which are
   smoothed towards those of all pages, are the host's prior. A page's own share
   is taken out before, so that it doesn't confirm itself.
4. The posterior is the product of the four, normalised.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import settle
from .common import attach_small, in_tasks
from .toxicity import hashed
from .url_filter import host_of

LENGTHS, BITS = (1, 2, 3), 15
BUCKETS = 1 << BITS
SMOOTHING = 0.5
#: Share of the n-grams' log-likelihood that counts, and the most that it weighs.
TEMPER, MOST = 0.1, 30.0
#: Pages that a parent's prior weighs against a host's or domain's own pages.
PRIOR_PAGES = 5.0
#: Pages that the overall shares weigh against those of a declaration or suffix.
EVIDENCE_PAGES = 2.0
#: At least this share stays with every language in each piece of evidence.
FLOOR = 0.02

#: Languages that the model can hold: it has a row of counts for each.
MOST_LANGUAGES = 256

RAW = re.compile(r"<(script|style)\b", re.I)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
ROOT = re.compile(r"<html\b", re.I)
LANG = re.compile(r"\blang\s*=\s*(?:[\"']\s*)?([a-zA-Z]{2,8})", re.I)


def visible_text(page: str | None) -> str:
    """Text without comments, scripts, styles and tags, each of which becomes a space.
    What is opened but never closed is a tag up to the next ``>``, or text.

    One pass: that an end is missing is looked up once, so the time grows with the
    length of the page, whatever is in it.
    """
    page = page or ""
    shown, at, missing = [], 0, set()
    while (start := page.find("<", at)) >= 0:
        end = -1
        if page.startswith("<!--", start) and "-->" not in missing:
            if (end := page.find("-->", start + 4)) < 0:
                missing.add("-->")
            else:
                end += 3
        if end < 0 and (raw := RAW.match(page, start)) and (name := raw[1].lower()) not in missing:
            if close := RAW_END[name].search(page, raw.end()):
                end = close.end()
            else:
                missing.add(name)
        if end < 0:
            end = page.find(">", start) + 1
            if not end:
                break
        shown += (page[at:start], " ")
        at = end
    shown.append(page[at:])
    return html.unescape("".join(shown))


def declared_language(page: str | None) -> str | None:
    """The lang of the first html tag that has one, in lower case; in one pass."""
    page = page or ""
    at = 0
    while root := ROOT.search(page, at):
        at = page.find(">", root.end())
        at = len(page) if at < 0 else at
        if found := LANG.search(page, root.end(), at):
            return found[1].lower()
    return None


def _counts(languages: list[str]) -> Callable:
    place = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, name in zip(batch["text"], batch["lang"].to_pylist()):
                for some in hashed(text.as_py(), LENGTHS, BITS):
                    counts[place[name]] += np.bincount(some, minlength=BUCKETS)
        row, bucket = np.nonzero(counts)
        columns = [pa.array(row), pa.array(bucket), pa.array(counts[row, bucket])]
        yield pa.RecordBatch.from_arrays(columns, ["language", "bucket", "n"])

    return run


def train_languages(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Language names and log-likelihoods (a row each) from all (text, lang) rows.

    Null languages teach nothing; null texts are empty. More than MOST_LANGUAGES are
    refused. The counts that reach the driver are one per language and bucket.
    """
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where("lang is not null")
    languages = sorted(r["lang"] for r in known.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"lang has over {MOST_LANGUAGES} values; are they languages?")
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    counted = in_tasks(known, _counts(languages), "language long, bucket long, n long")
    found = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[found["language"].astype(int), found["bucket"].astype(int)] += found["n"]
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True))


def text_posterior(text: str, likelihoods: np.ndarray) -> np.ndarray:
    """Language shares by the text alone; even without letters to go by."""
    counts = np.zeros(BUCKETS)
    for some in hashed(text, LENGTHS, BITS):
        counts += np.bincount(some, minlength=BUCKETS)
    evidence = TEMPER * (likelihoods @ counts) if text.strip() else np.zeros(len(likelihoods))
    shares = np.exp(np.maximum(evidence - evidence.max(), -MOST))
    return shares / shares.sum()


def _read(likelihoods: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared, shares = [], []
            for page in batch["html"]:
                page = page.as_py()
                declared.append(declared_language(page))
                shares.append(text_posterior(visible_text(page), likelihoods))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(declared, pa.string()),
                    pa.array(shares, pa.list_(pa.float64())),
                ],
                ["page_id", "url", "declared", "shares"],
            )

    return run


def _sums(rows: DataFrame, keys: list[str], names: list[str], prefix: str) -> DataFrame:
    """Sums of the text shares of each language by key: a partial aggregate."""
    return rows.groupBy(*keys).agg(*(F.sum(n).alias(prefix + n) for n in names))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, url, declared, text_language, language and confidence per page.

    ``pages`` needs page_id, url and html; ``docs`` has text and lang and teaches
    the text model. A null or empty page has no text evidence; without a declared
    language, a suffix or a host that evidence is left out, so a page with nothing
    gets the overall shares. Ties go to the first name. Repeated rows stay. Without
    any known language all results are null. Other columns are ignored.
    """
    languages, likelihoods = train_languages(docs)
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    if not languages:
        nothing = F.lit(None).cast("string")
        return rows.select(
            "page_id", "url", nothing.alias("declared"), nothing.alias("text_language"),
            nothing.alias("language"), F.lit(None).cast("double").alias("confidence"),
        )
    read = in_tasks(rows, _read(likelihoods), f"page_id {kind}, url string, declared string, shares array<double>")
    own = [f"own_{i}" for i in range(len(languages))]
    host = host_of(F.col("url"))
    numeric = host.rlike(r"^([0-9.]+|\[.*\])$")
    read = read.select(
        "page_id",
        "url",
        "declared",
        host.alias("host"),
        F.when(numeric, host).otherwise(F.substring_index(host, ".", -2)).alias("domain"),
        F.when(~numeric, F.substring_index(host, ".", -1)).alias("suffix"),
        *(F.get("shares", i).alias(n) for i, n in enumerate(own)),
    )
    read = settle(read)
    total = read.agg(*(F.sum(n) for n in own)).first()  # one row
    total = np.array([x or 0.0 for x in total]) + 1e-9
    overall = [float(x) for x in total / total.sum()]

    judged = read
    for key in ("declared", "suffix", "domain", "host"):
        keyed = read.where(F.col(key).isNotNull())
        judged = attach_small(judged, _sums(keyed, [key], own, f"{key}_"), key)

    def pages_of(key: str) -> Column:
        return reduce(Column.__add__, [F.coalesce(f"{key}_{n}", F.lit(0.0)) for n in own])

    def others(key: str, i: int) -> Column:
        """Pages of this language with the same key, without this page."""
        return F.greatest(F.lit(0.0), F.coalesce(f"{key}_{own[i]}", F.lit(0.0)) - F.col(own[i]))

    scores = []
    for i, _ in enumerate(languages):
        domain_n = F.greatest(F.lit(0.0), pages_of("domain") - 1)
        domain = (others("domain", i) + PRIOR_PAGES * overall[i]) / (domain_n + PRIOR_PAGES)
        host_n = F.greatest(F.lit(0.0), pages_of("host") - 1)
        prior = (others("host", i) + PRIOR_PAGES * domain) / (host_n + PRIOR_PAGES)
        score = F.log(F.col(own[i])) + F.log(F.greatest(F.lit(FLOOR), prior))
        for key in ("declared", "suffix"):
            # P(key | language) over P(key): by Bayes the share of the language among the key's pages
            n = F.greatest(F.lit(0.0), pages_of(key) - 1)
            share = (others(key, i) + EVIDENCE_PAGES * overall[i]) / (n + EVIDENCE_PAGES)
            lift = F.log(F.greatest(F.lit(FLOOR), share)) - F.log(F.lit(max(FLOOR, overall[i])))
            score = score + F.when(F.col(key).isNull(), 0.0).otherwise(lift)
        scores.append(score)
    names = F.array(*(F.lit(n) for n in languages))
    judged = judged.withColumns({f"score_{i}": s for i, s in enumerate(scores)})
    values = [F.col(f"score_{i}") for i in range(len(languages))]
    best = F.greatest(*values) if len(values) > 1 else values[0]
    norm = reduce(Column.__add__, [F.exp(v - best) for v in values])
    own_best = F.greatest(*own) if len(own) > 1 else F.col(own[0])
    return judged.select(
        "page_id",
        "url",
        "declared",
        F.get(names, F.array_position(F.array(*own), own_best).cast("int") - 1).alias("text_language"),
        F.get(names, F.array_position(F.array(*values), best).cast("int") - 1).alias("language"),
        F.round(1 / norm, 6).alias("confidence"),
    )
