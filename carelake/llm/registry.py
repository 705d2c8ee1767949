"""Queries of the corpus operators, each over the whole tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    block_neighbors,
    graph_neighbors,
    language,
    merkle,
    mixing,
    packing,
    quality,
    simhash,
    spelling,
    substring,
    token_count,
    toxicity,
    url_filter,
)
from .common import table, tokenizer_file
from .pipeline import packing_files


def toxicity_nb_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model)


def mixing_raked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def substring_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(table(spark, sf_dir, "documents"))


def packing_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *packing_files())


def url_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.evaluate(url_filter.dated_captures(pages), url_filter.derived_entries(pages))
    dates = {c: F.col(c).cast("string") for c in ("fetched", "listed_since")}
    return judged.withColumns(dates)


def token_counts_resync(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_count.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"))


def quality_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("host", "host_rate")


def language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def embedding_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_neighbors.near_vectors(table(spark, sf_dir, "embeddings"))


def simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def neighbors_int8_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return block_neighbors.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def spelling_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def merkle_pointer_jumping(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


QUERIES = {
    "op1_toxicity_nb_ngrams": toxicity_nb_ngrams,
    "op2_mixing_raked": mixing_raked,
    "op3_substring_anchors": substring_anchors,
    "op4_packing_hilbert": packing_hilbert,
    "op5_url_temporal_lists": url_temporal_lists,
    "op6_token_counts_resync": token_counts_resync,
    "op7_quality_host_rules": quality_host_rules,
    "op8_language_evidence": language_evidence,
    "op9_embedding_pruned_graph": embedding_pruned_graph,
    "op10_simhash_golay": simhash_golay,
    "op11_neighbors_int8_blocks": neighbors_int8_blocks,
    "op12_spelling_reduced_alphabet": spelling_reduced_alphabet,
    "op13_merkle_pointer_jumping": merkle_pointer_jumping,
}

#: Oracles in DuckDB's SQL.
ORACLE = {
    "op2_mixing_raked": mixing.oracle(),
    "op11_neighbors_int8_blocks": block_neighbors.ORACLE,
    "op12_spelling_reduced_alphabet": spelling.oracle(),
    "op13_merkle_pointer_jumping": merkle.oracle(),
    "op5_url_temporal_lists": r"""
WITH trimmed AS (
  SELECT page_id, url, regexp_replace(lower(url), '^[\x00-\x20]+', '') AS u,
    DATE '2023-01-01' + (('0x' || substr(md5(concat_ws('|', 'fetch', page_id::VARCHAR, url)), 1, 7))::BIGINT % 730)::INT AS fetched
  FROM pages
), places AS (
  SELECT *, CASE WHEN regexp_full_match(split_part(u, '://', 1), '[a-z][a-z0-9+.-]*') AND strpos(u, '://') > 0
    THEN regexp_extract(substr(u, strpos(u, '://') + 3), '^[^/?#]*') END AS place
  FROM trimmed
), named AS (
  SELECT *, list_last(string_split(place, '@')) AS named_host FROM places
), hosted AS (
  SELECT *, rtrim(CASE WHEN named_host LIKE '[%]%' THEN substr(named_host, 1, strpos(named_host, ']')) WHEN named_host LIKE '[%' THEN ''
    ELSE split_part(named_host, ':', 1) END, '.') AS h
  FROM named
), captures AS (
  SELECT page_id, url, fetched, CASE WHEN length(h) BETWEEN 1 AND 253 THEN h END AS host FROM hosted
), hosts AS (
  SELECT DISTINCT host FROM captures WHERE host IS NOT NULL
), host_keys AS (
  SELECT host, array_to_string(string_split(host, '.')[i:], '.') AS key
  FROM hosts, unnest(range(1, len(string_split(host, '.')) + 1)) AS t(i) WHERE host NOT LIKE '[%' OR i = 1
), drawn AS (
  SELECT key, 'entry|' || key || '|' || n AS name
  FROM (SELECT DISTINCT key FROM host_keys WHERE key LIKE '%.%'), unnest([1, 2, 3, 4]) AS t(n)
), entries AS (
  SELECT key, DATE '2023-01-01' + (('0x' || substr(md5('day|' || name), 1, 7))::BIGINT % 730)::INT AS since,
    CASE WHEN ('0x' || substr(md5(name), 1, 7))::BIGINT % 2 = 0 THEN 'block' ELSE 'allow' END AS action
  FROM drawn WHERE ('0x' || substr(md5(name), 1, 7))::BIGINT % 4 < 2
), daily AS (
  SELECT key, since, max(action) AS action FROM entries GROUP BY key, since
), active AS (
  SELECT *, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM daily
), verdicts AS (
  SELECT c.host, c.fetched, arg_max(struct_pack(k := a.key, s := a.since, a := a.action), length(a.key)) AS e
  FROM (SELECT DISTINCT host, fetched FROM captures) c
  JOIN host_keys USING (host)
  JOIN active a ON a.key = host_keys.key AND a.since <= c.fetched AND (a.until IS NULL OR c.fetched < a.until)
  GROUP BY c.host, c.fetched
)
SELECT page_id, url, c.fetched::VARCHAR AS fetched, c.host, e.k AS matched, e.s::VARCHAR AS listed_since,
  e.a AS action, coalesce(e.a = 'block', false) AS blocked
FROM captures c LEFT JOIN verdicts v ON v.host = c.host AND v.fetched = c.fetched
""",
    "op7_quality_host_rules": r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT row_id, i, list_extract(words, i) || ' ' || list_extract(words, i + 1) || ' ' || list_extract(words, i + 2) AS w
  FROM split, unnest(range(1, len(words) - 1)) AS t(i)
), repeats AS (
  SELECT row_id, i FROM (SELECT *, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row_id, count(DISTINCT i + k) AS n FROM repeats, unnest([0, 1, 2]) AS t(k) GROUP BY row_id
), figures AS (
  SELECT doc_id, host, len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(array_to_string(words, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (row_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
), hosts AS (
  SELECT host, count(*) AS n_docs, sum(base_failed::INT) AS n_failed FROM judged WHERE host IS NOT NULL GROUP BY host
), moments AS (
  SELECT avg(n_failed / n_docs) AS m, coalesce(var_samp(n_failed / n_docs), 0) AS v, avg(1 / n_docs) AS share FROM hosts
), prior AS (
  SELECT m, greatest(2.0, least(1000.0, CASE WHEN v - m * (1 - m) * share > 0
    THEN m * (1 - m) / (v - m * (1 - m) * share) - 1 ELSE 1000.0 END)) AS s FROM moments
), verdicts AS (
  SELECT host, (n_failed + s * m) / (n_docs + s) > 0.5 AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM judged LEFT JOIN verdicts USING (host)
""",
}
