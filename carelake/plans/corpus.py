"""Literature corpus: collect, embed, index, retrieve."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import EMBEDDING_DIM
from ..functions.literature import citation_url, embedding_text, fill_payload, point_id
from ..functions.vectors import Embedder, hashed_embedder
from ..operators.dedupe import first_query_wins
from ..operators.mutate import new_articles, replace_rows
from ..operators.inverted_index import InvertedIndex
from ..operators.lookup import attach, broadcast_if_small
from ..operators.nearest import top_k
from ..runtime import counted, settle
from ..schemas import INDEX_SCHEMA
from ..sources.articles import read_corpus
from ..sources.tables import (
    BUCKET,
    DEFAULT_BUCKETS,
    create_bucketed,
    read_table,
    require_dimension,
    save_table,
    table_exists,
    upsert_bucketed,
)

PAYLOAD = ["pmid", "title", "abstract", "journal", "year", "authors"]


def ensure_index(spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS) -> bool:
    """Create an empty index, bucketed by point id; true if it was not there yet."""
    return create_bucketed(spark, path, INDEX_SCHEMA, buckets)


def collect_corpus(found: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Articles found by ordered searches, each once, without those known already."""
    once = first_query_wins(found)
    return once if existing is None else new_articles(existing, once)


def embed_articles(
    abstracts: DataFrame, embedder: Embedder | None = None, dim: int = EMBEDDING_DIM
) -> tuple[DataFrame, DataFrame]:
    """Index points, and the articles whose PMID is not a number."""
    embedder = embedder or hashed_embedder(dim)
    texts = abstracts.withColumns(
        {
            "point_id": point_id(F.col("pmid")),
            "_text": embedding_text(F.col("title"), F.col("abstract")),
        }
    )
    points = embedder(texts.filter(F.col("point_id").isNotNull()), "_text", "vector")
    rejected = abstracts.filter(point_id(F.col("pmid")).isNull())
    return require_dimension(points.drop("_text"), dim), rejected


def _entries(
    spark: SparkSession, corpus_path: str, embedder: Embedder | None, array_file: bool, dim: int
) -> tuple[DataFrame, int]:
    """Index points of a corpus, the last entry of a PMID, and how many entries it has.

    The last one is that of the last file, by path. Only PMIDs and places are looked
    at to find it: texts move once, to where they are written.
    """
    placed = read_corpus(spark, corpus_path, array_file, entry="_place")
    narrow, seen = counted(placed.select("pmid", "_place"))
    narrow = settle(narrow)  # the files are parsed once for this, and once for the texts
    bad = narrow.where(point_id(F.col("pmid")).isNull()).select("pmid").take(1)
    if bad:
        raise ValueError(f"pmid is not a number: {bad[0].pmid!r}")
    last = narrow.groupBy("pmid").agg(F.count(F.lit(1)).alias("n"), F.max("_place").alias("last"))
    repeated = settle(last.where("n > 1").select("pmid", "last"))
    beaten = narrow.join(repeated, "pmid").where("_place < last").select("_place")
    kept = placed.join(broadcast_if_small(settle(beaten)), "_place", "left_anti").drop("_place")
    points, _ = embed_articles(kept, embedder, dim)
    return points.select(*INDEX_SCHEMA.names), seen.get["rows"]


def index_corpus(
    spark: SparkSession,
    corpus_path: str,
    output_path: str,
    previous_path: str | None = None,
    embedder: Embedder | None = None,
    array_file: bool = False,
    dim: int = EMBEDDING_DIM,
) -> int:
    """Write a new index snapshot: the previous one with the corpus upserted.

    Returns the articles read. Of a PMID that the corpus names more than once the
    last entry stays. ``update_index`` keeps one table instead and leaves the files
    of untouched buckets alone.
    """
    if previous_path is not None and str(previous_path) == str(output_path):
        raise ValueError("a snapshot cannot replace the one it is built from")
    points, read = _entries(spark, corpus_path, embedder, array_file, dim)
    if previous_path is not None and table_exists(spark, previous_path):
        points = replace_rows(read_table(spark, previous_path).drop(BUCKET), points, "point_id")
    save_table(points, output_path, mode="overwrite")
    return read


def update_index(
    spark: SparkSession,
    corpus_path: str,
    index_path: str,
    embedder: Embedder | None = None,
    array_file: bool = False,
    dim: int = EMBEDDING_DIM,
    buckets: int = DEFAULT_BUCKETS,
) -> int:
    """Upsert a corpus into an index that is bucketed by point id, and created with
    that many buckets if absent. Returns the articles read; of a PMID that the corpus
    names more than once the last entry stays."""
    create_bucketed(spark, index_path, INDEX_SCHEMA, buckets)
    points, read = _entries(spark, corpus_path, embedder, array_file, dim)
    upsert_bucketed(points, index_path, "point_id")
    return read


def retrieve(
    queries: DataFrame,
    index: DataFrame | InvertedIndex,
    k: int = 3,
    embedder: Embedder | None = None,
    query: str = "query",
    exact: bool = True,
) -> DataFrame:
    """The k most similar documents of each distinct query text.

    Equal texts are looked up once; blank ones find nothing. A stored index is read
    in the lists that can hold a result (``exact``), or in those nearest to the query.
    """
    embedder = embedder or hashed_embedder()
    texts = queries.filter(F.col(query).rlike(r"\S")).select(query).distinct()
    asked = embedder(texts, query, "vector")
    if isinstance(index, InvertedIndex):
        near = index.search(asked, k, exact=exact, query_key=query, document_key="point_id")
        index = index.members
    else:
        near = top_k(asked, index, k, query_key=query, document_key="point_id")
    near = settle(near)
    documents = index.select("point_id", *[c for c in PAYLOAD if c in index.columns])
    hits = near.select("point_id").distinct()
    hit_documents = documents.join(broadcast_if_small(hits), "point_id", "left_semi")
    # an article that many queries cite is one key: broadcast, or split by AQE
    found = fill_payload(attach(near, hit_documents, "point_id", "inner"))
    return found.select(
        query,
        "rank",
        *PAYLOAD,
        "score",
        citation_url(F.col("pmid")).alias("pubmed_url"),
    )
