"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to a few symbols. Words one edit apart have reduced words that
are equal or one edit apart, so the full one-edit neighbourhood of every reduced
word is generated (each neighbour as a 64-bit hash, made from hashes of what stands
before and behind the edit) and joined with the reduced vocabulary. Pairs that meet
are verified on the original words, so equal hashes of different strings cost a
comparison and change nothing.

Words that share a reduced word form a bucket. Pairs of buckets are compared word
by word only where both are small. Where one is not, the words of both are searched
again over the whole alphabet, in which a bucket is a single word: hot buckets cost
longer neighbourhoods, not pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import broadcast_if_small
from ..runtime import settle
from .common import BROADCAST_BYTES, CRC_TABLE_SQL, attach_small, crc32_sql, in_tasks

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form occurs at least so many times as often as its variant.
RATIO = 5
#: One run in so many, by its hash, loses a letter.
DELETED = 199
SYMBOLS = 8
#: Buckets of more words are searched over the whole alphabet.
BUCKET = 64
#: Distinct words a task counts before it passes them on.
COUNTED = 200_000
#: Neighbours of one word that are made at a time.
KEYS = 1 << 20

LETTERS = "".join(chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100)))
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
SMALL = {c: c + 32 for c in range(0x41, 0x5B)}

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


# --- counting ---------------------------------------------------------------------


def spelled(run: str, start: int) -> str:
    """The word that a run counts as; ``start`` is the checksum of its document."""
    low = run.translate(SMALL)
    return _changed(low.encode(), zlib.crc32(low.encode(), start)).decode()


def _changed(low: bytes, h: int) -> bytes:
    if h % DELETED:
        return low
    word = low.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[bytes, int] = {}
    known: dict[str, bytes] = {}

    def flushed() -> pa.RecordBatch:
        words, n = pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())
        total.clear()
        known.clear()
        return pa.RecordBatch.from_arrays([words, n], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            if not text.is_valid:
                continue
            start = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            # a run of at least six letters matches from its first letter to its last
            for match in RUN.finditer(text.as_py()):
                run = match[0]
                low = known.get(run)
                if low is None:
                    low = known[run] = run.translate(SMALL).encode()
                h = zlib.crc32(low, start)
                if h % DELETED == 0:
                    low = _changed(low, h)
                    if len(low.decode()) < LEAST_LENGTH:
                        continue
                total[low] = total.get(low, 0) + 1
                if len(total) >= COUNTED:
                    yield flushed()
    yield flushed()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n, the occurrences in all documents, of the words that count."""
    counted = in_tasks(docs.select("doc_id", F.col("text").cast("string").alias("text")), _counted, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# --- neighbourhoods ---------------------------------------------------------------


def alphabet(symbols: int) -> str:
    """The symbol that each of LETTERS is hashed to, written as one of the first letters."""
    return "".join(LETTERS[zlib.crc32(c.encode()) % symbols] for c in LETTERS)


#: Symbol, from 1, of each code point up to U+00FF. Reduced words are written with
#: the first letters, so the table holds for them too.
_SYMBOL = np.zeros(0x100, np.uint64)
_SYMBOL[[ord(c) for c in LETTERS]] = np.arange(1, len(LETTERS) + 1)


def by_length(words: list[str], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, at most ``most`` letters at a time, and their
    symbols as rows."""
    length = np.array([len(w) for w in words], np.int64)
    for n in np.unique(length):
        places = np.nonzero(length == n)[0]
        step = max(1, most // max(int(n), 1))
        for at in range(0, len(places), step):
            part = places[at : at + step]
            points = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le"), np.uint32)
            yield part, _SYMBOL[points].reshape(len(part), n)


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, BASE, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _before(codes: np.ndarray) -> np.ndarray:
    """Hash of what stands before each place of each row, and of the whole row last."""
    sums = np.cumsum(codes * _powers(codes.shape[1] + 1)[: codes.shape[1]], axis=1, dtype=np.uint64)
    return np.concatenate([np.zeros((len(codes), 1), np.uint64), sums], axis=1)


def keys_of(codes: np.ndarray) -> np.ndarray:
    """The hash of each row of symbols."""
    return _mixed(_before(codes)[:, -1])


def neighbour_keys(codes: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows, and hashes of the row and of all strings one edit from it, each string
    once, in parts of bounded size: of equal neighbours that edits at different places
    make, the one at the last place is taken."""
    rows, n = codes.shape
    power = _powers(n + 2)
    before = _before(codes)
    total = before[:, -1:]
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    yield np.arange(rows), _mixed(total[:, 0])
    step = max(1, KEYS // (max(rows, 1) * 2 * symbols))
    for at in range(0, n + 1, step):
        i = np.arange(at, min(at + step, n + 1))
        j = i[i < n]
        other = every != codes[:, j, None]
        replaced = total[:, :, None] + (every - codes[:, j, None]) * power[j][None, :, None]
        # before an equal symbol it would be the same as behind it
        fresh = np.ones((rows, len(i), symbols), bool)
        fresh[:, : len(j)] = other
        inserted = (before[:, i] + (total - before[:, i]) * BASE)[:, :, None] + every * power[i][None, :, None]
        deleted = before[:, j] + (total - before[:, j + 1]) * INVERSE
        last = np.ones(deleted.shape, bool)
        inner = j < n - 1
        last[:, inner] = codes[:, j[inner]] != codes[:, j[inner] + 1]
        held = [np.nonzero(m) for m in (other, fresh, last)]
        owners = np.concatenate([h[0] for h in held])
        keys = np.concatenate([made[h] for made, h in zip((replaced, inserted, deleted), held)])
        yield owners, _mixed(keys)


def with_keys(words: DataFrame, word: str) -> DataFrame:
    """(id, key): the hash of each string."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(batch.num_rows, np.int64)
            for places, codes in by_length(batch[word].to_pylist(), KEYS):
                keys[places] = keys_of(codes)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(keys)], ["id", "key"])

    return in_tasks(words.select("id", word), keyed, "id long, key long")


def with_neighbours(words: DataFrame, word: str, symbols: int) -> DataFrame:
    """(id, key): hashes of each string's whole one-edit neighbourhood over the first
    ``symbols`` symbols."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"].to_numpy()
            for places, codes in by_length(batch[word].to_pylist(), max(1, KEYS // (2 * symbols))):
                for rows, keys in neighbour_keys(codes, symbols):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[places[rows]]), pa.array(keys)], ["id", "key"])

    return in_tasks(words.select("id", word), spread, "id long, key long")


# --- pairs ------------------------------------------------------------------------


def _met(probes: DataFrame, known: DataFrame) -> DataFrame:
    """(id, other) of probes and known strings with equal keys, each pair once. Known
    strings are broadcast if they measure small: then no probe moves."""
    held = known.select("key", F.col("id").alias("other"))
    return settle(probes.join(broadcast_if_small(held, BROADCAST_BYTES), "key").select("id", "other").distinct())


def _verified(pairs: DataFrame) -> DataFrame:
    """Of (word, near) those that are one edit apart."""
    return pairs.where((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "near")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS, bucket: int = BUCKET) -> DataFrame:
    """(word, near) for all pairs of distinct ``word`` s one edit apart, both ways."""
    reduced = words.select("word", F.translate("word", LETTERS, alphabet(symbols)).alias("form"))
    forms = reduced.groupBy("form").agg(F.count(F.lit(1)).alias("size"))
    forms = settle(forms.withColumn("id", F.monotonically_increasing_id()))
    named = settle(reduced.join(forms, "form").select("word", "id", "size"))
    known = settle(with_keys(forms, "form"))
    # few bytes, much work: the strings are dealt anew
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    met = _met(with_neighbours(forms.repartition(tasks, "id"), "form", symbols), known)
    size = forms.select("id", "size")
    met = met.join(broadcast_if_small(size, BROADCAST_BYTES), "id")
    met = met.join(broadcast_if_small(size.toDF("other", "other_size"), BROADCAST_BYTES), "other")

    small = met.where((F.col("size") <= bucket) & (F.col("other_size") <= bucket)).select("id", "other")
    others = named.select(F.col("id").alias("other"), F.col("word").alias("near"))
    found = _verified(small.join(named.select("id", "word"), "id").join(others, "other"))

    hot = met.where((F.col("size") > bucket) | (F.col("other_size") > bucket)).select("id").distinct()
    if hot.isEmpty():
        return found
    again = named.join(hot, "id", "left_semi").select("word", (F.col("size") > bucket).alias("hot"))
    again = settle(again.withColumn("id", F.monotonically_increasing_id()))
    pairs = _met(with_neighbours(again.repartition(tasks, "id"), "word", len(LETTERS)), with_keys(again, "word"))
    one, two = again.select("id", "word", "hot"), again.toDF("near", "near_hot", "other")
    # pairs of words from small buckets were found above
    whole = pairs.join(one, "id").join(two, "other").where("hot or near_hot")
    return found.unionByName(_verified(whole))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), form not null: the last form of the chain. A
    form is more frequent than its variant, so chains end; each round doubles how far
    a word looks."""
    forms = settle(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")))
    while not forms.where(~F.col("done")).isEmpty():
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = attach_small(forms, onward, "root")
        forms = settle(met.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNull().alias("done")))
    return forms.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``docs`` (doc_id, text).

    Words are what ``spelled`` makes of the runs of at least six letters, if that has
    six letters itself and occurs five times. Near words are one code point inserted,
    deleted or replaced away; a swap of neighbours is two edits. Of near words with
    equal n the first in code-point order is taken. Null and empty texts have no
    words; a null doc_id counts as empty text. Repeated rows count each time. Runs of
    any length are words. No words: no rows. Further columns are not read.
    """
    words = settle(vocabulary(docs))
    pairs = near_pairs(words)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")))
    near = pairs.join(counts, "near").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= RATIO * F.col("n"), F.struct("best.word", (-F.col("best.less")).alias("n"))).alias("best"),
    )
    judged = settle(judged.select("word", "n", "n_near", F.col("best.word").alias("form"), F.col("best.n").alias("form_n")))
    ends = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def oracle() -> str:
    """The same in DuckDB's SQL: pairs share what is left when a letter is dropped.
    Its edit distance counts bytes, so other letters are written in ASCII for it."""
    ascii_signs = "".join(chr(c) for c in range(33, 127) if not chr(c).islower() and chr(c) not in "'{}")
    plain = f"translate({{}}, '{LETTERS[26:]}', '{ascii_signs[:64]}')"
    return f"""
WITH RECURSIVE {CRC_TABLE_SQL}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
), hashed AS (
  SELECT run, n, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL), crc_table
), counted AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM counted WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), rests AS (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(range(1, length(word) + 2)) AS t(i)
), pairs AS (
  SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM rests a JOIN rests b ON a.rest = b.rest AND a.word <> b.word
  WHERE levenshtein({plain.format("a.word")}, {plain.format("b.word")}) = 1
), near AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM pairs GROUP BY word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form,
    CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL
  SELECT chain.word, judged.word, judged.form FROM chain JOIN judged ON judged.word = chain.next
)
SELECT judged.*, root FROM judged JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""
