import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelake.functions.literature import citation_url, embedding_text, fill_payload, point_id
from carelake.functions.vectors import cosine, hashed_embedder, l2_norm, model_embedder, normalize
from carelake.operators.dedupe import first_query_wins
from carelake.operators.nearest import top_k
from carelake.plans import corpus
from carelake.plans.corpus import (
    collect_corpus,
    embed_articles,
    ensure_index,
    index_corpus,
    retrieve,
)
from carelake.schemas import ABSTRACT_SCHEMA, CORRUPT_RECORD
from carelake.sources.articles import read_article_xml, read_corpus, write_corpus
from carelake.sources.tables import read_table, require_dimension

XML = """<?xml version="1.0"?>
<PubmedArticleSet>
<PubmedArticle><MedlineCitation><PMID>11</PMID><Article>
  <Journal><JournalIssue><PubDate><Year>2020</Year></PubDate></JournalIssue><Title>J &amp; Co</Title></Journal>
  <ArticleTitle>Stay <i>well</i></ArticleTitle>
  <Abstract><AbstractText Label="AIM"> To see. </AbstractText><AbstractText/>
    <AbstractText>yo <i>it</i> z</AbstractText><AbstractText Label="END"/></Abstract>
  <AuthorList><Author><LastName>Doe</LastName><Initials>J</Initials></Author>
    <Author><LastName>Roe</LastName></Author><Author/></AuthorList>
</Article></MedlineCitation></PubmedArticle>
<PubmedArticle Status="x"><MedlineCitation><PMID>12</PMID><Article>
  <ArticleTitle>No abstract</ArticleTitle></Article></MedlineCitation></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>13</PMID><Article>
  <Abstract><AbstractText>Short.</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>
</PubmedArticleSet>
"""


def abstracts(spark, *rows):
    full = [
        (pmid, title, text, "J", "2020", ["A B"], "q") for pmid, title, text in rows
    ]
    return spark.createDataFrame(full, ABSTRACT_SCHEMA)


def test_article_fields(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    got = {r.pmid: r for r in read_article_xml(spark, str(tmp_path)).collect()}
    assert sorted(got) == ["11", "13"]
    assert got["11"].asDict() == {
        "pmid": "11",
        "title": "Stay ",
        "abstract": "AIM: To see. yo END: ",
        "journal": "J & Co",
        "year": "2020",
        "authors": ["Doe J", "Roe"],
    }
    assert (got["13"].title, got["13"].authors) == ("", [])


def test_articles_split_over_tasks(spark, tmp_path):
    one = XML[XML.index("<PubmedArticle>") : XML.index("</PubmedArticleSet>")]
    many = "<PubmedArticleSet>" + "".join(one.replace(">11<", f">{i}<") for i in range(100, 400))
    (tmp_path / "a.xml").write_text(many + "</PubmedArticleSet>")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        parsed = read_article_xml(spark, str(tmp_path / "a.xml"))
        assert parsed.rdd.getNumPartitions() > 5
        pmids = [r.pmid for r in parsed.filter("pmid <> '13'").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(map(int, pmids)) == list(range(100, 400))


def test_malformed_article(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML.replace("<ArticleTitle>No abstract", "<ArticleTitle>No <abstract"))
    kept = read_article_xml(spark, str(tmp_path), mode="PERMISSIVE").collect()
    assert [r.pmid for r in kept if r[CORRUPT_RECORD] is None] == ["11", "13"]
    assert [">12<" in r[CORRUPT_RECORD] for r in kept if r[CORRUPT_RECORD]] == [True]
    with pytest.raises(Exception, match="ParseError"):
        read_article_xml(spark, str(tmp_path)).count()


def test_corpus_files(spark, tmp_path):
    rows = abstracts(spark, ("1", "a", "b"), ("2", "ä\n", None))
    write_corpus(rows, str(tmp_path / "lines"))
    back = read_corpus(spark, str(tmp_path / "lines"))
    assert sorted(back.collect()) == sorted(rows.collect())
    array = [json.loads(r) for r in rows.toJSON().collect()]
    (tmp_path / "array.json").write_text(json.dumps(array, indent=2))
    back = read_corpus(spark, str(tmp_path / "array.json"), array_file=True)
    assert sorted(back.collect()) == sorted(rows.collect())


def test_first_query_wins(spark):
    found = spark.createDataFrame(
        [("1", "b", 2, 1), ("1", "a", 1, 9), ("2", "b", 2, 2)],
        "pmid string, query string, query_no int, position int",
    )
    assert {(r.pmid, r.query) for r in first_query_wins(found).collect()} == {("1", "a"), ("2", "b")}
    known = spark.createDataFrame([("1",)], "pmid string")
    assert [r.pmid for r in collect_corpus(found, known).collect()] == ["2"]


def test_expressions(spark):
    df = spark.createDataFrame([("12", "t", None), ("PMC1", None, "a")], "pmid string, title string, abstract string")
    got = df.select(
        embedding_text(F.col("title"), F.col("abstract")), citation_url(F.col("pmid")), point_id(F.col("pmid"))
    ).collect()
    assert tuple(got[0]) == ("t\n\n", "https://pubmed.ncbi.nlm.nih.gov/12/", 12)
    assert (got[1][0], got[1][2]) == ("\n\na", None)
    filled = fill_payload(df.select("pmid", "title")).orderBy("pmid").collect()
    assert [(r.title, r.abstract, r.authors, r.score) for r in filled] == [("t", "", [], 0.0), ("", "", [], 0.0)]


def test_vector_expressions(spark):
    df = spark.sql("SELECT array(3f, 4f) a, array(4f, 3f) b, array(0f, 0f) z")
    a, b, z = map(F.col, "abz")
    got = df.select(l2_norm(a), cosine(a, b), cosine(a, z), normalize(a), normalize(z)).first()
    assert tuple(got[:3]) == pytest.approx((5.0, 0.96, 0.0))
    assert got[3] == pytest.approx([0.6, 0.8]) and got[4] == [0.0, 0.0]


def test_hashed_embedding_is_unit_and_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("Heart failure",), ("heart FAILURE",), ("x " * 5000,)], "text string")
    out = hashed_embedder()(df, "text", "vector")
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    vectors = [np.array(r.vector) for r in out.collect()]
    assert all(len(v) == 384 and np.isclose(np.linalg.norm(v), 1) for v in vectors)
    assert np.array_equal(vectors[0], vectors[1])
    assert out.limit(0).count() == 0


def test_model_embedding(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("a" * i,) for i in range(1, 101)], "text string")
    out = model_embedder(load, batch_size=7)(df, "text", "vector").collect()
    assert len(out) == 100
    for r in out:
        n = len(r.text)
        assert r.vector == pytest.approx([n / np.hypot(n, 1), 1 / np.hypot(n, 1)], rel=1e-6)


def test_dimension_is_checked(spark):
    with pytest.raises(Exception, match="vector of size 2, collection holds 3"):
        require_dimension(spark.sql("SELECT array(1f, 2f) vector"), 3).collect()


def brute_force(queries, documents, k):
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    rows = set()
    for q, qv in queries:
        scored = sorted((-round(float(unit(qv) @ unit(dv)), 9), d) for d, dv in documents)
        rows |= {(q, d, i + 1) for i, (_, d) in enumerate(scored[:k])}
    return rows


@pytest.mark.parametrize(
    "limits",
    [
        {},
        {"broadcast_values": 40 * 4},
        {"broadcast_values": 0, "block_values": 7 * 4},
    ],
    ids=["documents scanned", "queries scanned", "block pairs"],
)
def test_nearest_is_exact_whichever_way(spark, limits):
    rng = np.random.default_rng(5)
    documents = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    documents += [(100 + i, documents[0][1]) for i in range(20)]  # a third are copies
    queries = [(f"q{i:03}", rng.normal(size=4).tolist()) for i in range(50)] + [("copy", documents[0][1])]
    if "block_values" not in limits and limits:
        documents = documents[:30]
    q = spark.createDataFrame(queries, "query_key string, vector array<double>").repartition(3)
    d = spark.createDataFrame(documents, "document_key long, vector array<double>").repartition(4)
    got = top_k(q, d, 3, **limits)
    assert {(r.query_key, r.document_key, r.rank) for r in got.collect()} == brute_force(queries, documents, 3)


def test_nearest_with_little_to_find(spark):
    q = spark.createDataFrame([("a", [1.0, 0.0])], "query_key string, vector array<double>")
    d = spark.createDataFrame([(1, [1.0, 1.0]), (2, [0.0, 0.0])], "document_key long, vector array<double>")
    assert [(r.document_key, round(r.score, 4)) for r in top_k(q, d, 5).orderBy("rank").collect()] == [
        (1, 0.7071),
        (2, 0.0),
    ]
    assert top_k(q.limit(0), d).count() == 0
    assert top_k(q, d.limit(0)).count() == 0


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("index")
    rows = abstracts(
        spark,
        ("1", "heart failure", "discharge of heart failure patients"),
        ("2", "pneumonia", "elderly pneumonia"),
        ("3", "stroke", "rehabilitation after stroke"),
        ("4", "sepsis", "sepsis recovery"),
    )
    write_corpus(rows, str(root / "corpus"))
    assert index_corpus(spark, str(root / "corpus"), str(root / "v1")) == 4
    return root


def test_index_again_replaces_points(spark, index):
    changed = abstracts(spark, ("4", "sepsis", "changed"), ("5", "new", "new"))
    write_corpus(changed, str(index / "more"))
    assert index_corpus(spark, str(index / "more"), str(index / "v2"), str(index / "v1")) == 2
    got = {r.point_id: r for r in read_table(spark, str(index / "v2")).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert (got[4].abstract, got[1].title) == ("changed", "heart failure")
    with pytest.raises(ValueError, match="snapshot"):
        index_corpus(spark, str(index / "more"), str(index / "v1"), str(index / "v1"))


def test_empty_index(spark, index, tmp_path):
    path = str(tmp_path / "v0")
    assert ensure_index(spark, path) and not ensure_index(spark, path)
    queries = spark.createDataFrame([("stroke",)], "query string")
    assert retrieve(queries, read_table(spark, path)).count() == 0
    assert index_corpus(spark, str(index / "corpus"), str(tmp_path / "v1"), path) == 4
    assert read_table(spark, str(tmp_path / "v1")).count() == 4


def test_pmid_must_be_a_number(spark, tmp_path):
    rows = abstracts(spark, ("PMC9", "t", "a"), ("9", "t", "a"))
    points, rejected = embed_articles(rows)
    assert [r.point_id for r in points.collect()] == [9]
    assert [r.pmid for r in rejected.collect()] == ["PMC9"]
    write_corpus(rows, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="PMC9"):
        index_corpus(spark, str(tmp_path / "c"), str(tmp_path / "v"))


def test_retrieve(spark, index):
    stored = read_table(spark, str(index / "v1"))
    texts = ["heart failure discharge", "pneumonia", "", "  ", "pneumonia"]
    queries = spark.createDataFrame([(t,) for t in texts], "query string")
    got = retrieve(queries, stored, k=2).collect()
    assert {(r.query, r.rank) for r in got} == {
        ("heart failure discharge", 1),
        ("heart failure discharge", 2),
        ("pneumonia", 1),
        ("pneumonia", 2),
    }
    best = {r.query: r for r in got if r["rank"] == 1}
    assert best["heart failure discharge"].pmid == "1"
    assert best["pneumonia"].pubmed_url.endswith("/2/")
    assert all(-1 <= r.score <= 1.000001 and r.authors == ["A B"] for r in got)


def test_partial_payload_gets_defaults(spark, index):
    bare = read_table(spark, str(index / "v1")).select("point_id", "vector", "pmid")
    got = retrieve(spark.createDataFrame([("stroke",)], "query string"), bare, k=1).first()
    assert (got.pmid, got.title, got.authors) == ("3", "", [])


@pytest.mark.parametrize("size", ["64", "1000", "134217728"])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_files_are_split(spark, tmp_path, size, indent):
    from carelake.sources.json_array import read_json_array
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("id int, text string, more struct<a: string, deep: struct<b: string>>, tags array<struct<t: string>>")
    hard = ['plain', '{', '}', '"', '\\', '\\"}{"', '}],[{', 'é{日本}', '"{\\\\"', '', "x" * 300]
    for name, n in (("a.json", 60), ("b.json", 0), ("c.json", 1)):
        rows = [
            {"id": i, "text": hard[i % len(hard)], "more": {"a": hard[(i + 3) % len(hard)], "deep": {"b": "}"}}, "tags": [{"t": "{"}, {"t": t}]}
            for i, t in ((i, hard[(i * 7) % len(hard)]) for i in range(n))
        ]
        (tmp_path / name).write_text(json.dumps(rows, indent=indent, ensure_ascii=n > 1))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = sorted((r.id, r.text, r.more.a, r.tags[1].t) for r in read_json_array(spark, str(tmp_path), schema).collect())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [(i, hard[i % 11], hard[(i + 3) % 11], hard[(i * 7) % 11]) for i in range(60)]
    assert got == sorted([*want, want[0]])


def test_broken_array_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"pmid": "1"}, {"pmid": "2"')
    with pytest.raises(Exception):
        read_corpus(spark, str(tmp_path), array_file=True).collect()


def test_words_of_many_texts_are_counted_at_once(monkeypatch):
    import numpy as np
    import pandas as pd

    from carelake.functions import vectors

    monkeypatch.setattr(vectors, "REMEMBERED_WORDS", 2)  # forgetting changes nothing
    texts = ["Ab ab-9É x", "", None, "İſ K—é", " z\x00Q9 z\n"]
    words = [["ab", "ab", "9", "x"], [], [], ["k"], ["z", "q9", "z"]]
    wanted = np.zeros((5, 7), "int64")
    for row, found in zip(wanted, words):
        for word in found:
            place, sign = vectors.digest_place(word, 7)
            row[place] += sign
    got = vectors.counted_places(pd.Series(texts), vectors.KnownPlaces(7))
    assert np.array_equal(got, wanted)


def test_whole_numbers_as_round_gives_them(spark):
    from carelake.plans.catalog import rounded_half_up

    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 0.0, 7.0, 123456.5, 999999.4999999999, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(rounded_half_up(F.col("x")).alias("got"), F.round("x").cast("long").alias("want"))
    assert [r.got for r in rows.collect()] == [r.want for r in rows.collect()]
    assert "round(" not in rows.select("got")._jdf.queryExecution().optimizedPlan().toString()


def test_array_files_grow_in_number_with_the_table(spark, tmp_path, monkeypatch):
    from carelake.plans import catalog

    rows = spark.range(0, 60, 1, 6).selectExpr(
        "id AS doc_id", "concat('t', id) AS text", "'en' AS lang", "'s1' AS source", "2L AS n_chars"
    )
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a task per file
    try:
        assert catalog.corpus_array(spark, str(tmp_path)).count() == 60
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((tmp_path / "corpus").glob("part-*"))) == 6


def test_corpus_is_parsed_for_the_places_and_for_the_texts_only(spark, tmp_path, monkeypatch):
    entries = [(str(i % 50), f"t{i}", "word", "j", "2020", ["a"], "q") for i in range(60)]
    write_corpus(spark.createDataFrame(entries, ABSTRACT_SCHEMA), str(tmp_path / "c"))
    parsed, read = spark.sparkContext.accumulator(0), corpus.read_corpus

    @F.udf("string")
    def noted(pmid):
        parsed.add(1)
        return pmid

    noted = noted.asNondeterministic()
    monkeypatch.setattr(corpus, "read_corpus", lambda *a, **k: read(*a, **k).withColumn("pmid", noted("pmid")))
    assert corpus.index_corpus(spark, str(tmp_path / "c"), str(tmp_path / "v")) == 60
    assert spark.read.parquet(str(tmp_path / "v")).count() == 50
    assert parsed.value <= 2 * 60
