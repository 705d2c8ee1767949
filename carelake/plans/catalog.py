"""Registered queries: each runs over the whole tables of a data folder."""

from __future__ import annotations

from math import ceil

import pyarrow as pa
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import LABEL, PATIENT_COLUMNS
from ..functions.clinical import (
    clinical_query,
    percent,
    predicted_label,
    risk_band,
)
from ..functions.contributions import (
    negative_contributions,
    positive_contributions,
    top_contributions,
)
from ..functions.literature import citation_url, embedding_text, fill_payload, point_id
from ..functions.vectors import cosine, digest_embedder, hashed_embedder, l2_norm, normalize
from ..operators import cohorts
from ..operators.cleanse import (
    bronze_to_silver,
    drop_missing_mrn,
    normalize_sex,
    validate_age,
)
from ..operators.contract import (
    REASONS,
    REQUEST_COLUMNS,
    patient_lineage,
    project_patient,
    split_gold,
    split_requests,
)
from ..operators.dedupe import first_query_wins
from ..operators.features import feature_names, patients_to_features, quoted, split_features_label
from ..operators.forest import (
    TrainingResult,
    load_model,
    predict_label,
    predict_proba,
    top_importances,
    train_model,
)
from ..operators.forest_rows import (
    importance_by_name,
    read_nodes,
    rule_nodes,
    score_features,
    with_stats,
)
from ..operators.inverted_index import InvertedIndex, build_index, recall
from ..operators.metrics import binary_metrics, class_weights, positive_rate
from ..operators.mutate import (
    delete_by_ids,
    duplicate_mrns,
    new_articles,
    new_patients,
    upsert,
    with_ids,
)
from ..operators.nearest import top_k
from ..operators.ranking import stratified_split, with_positions
from ..operators.shap import Explainer
from ..runtime import scratch_path, settle
from ..schemas import ABSTRACT_SCHEMA
from ..sources.articles import read_article_xml, read_corpus, write_corpus
from ..sources.bronze import ingest_raw_csv, read_bronze, read_csv
from ..sources.jdbc import redacted
from ..sources.tables import read_table, save_table
from ..streaming.bronze_stream import ingest_new_files
from ..streaming.silver_stream import merge_batch, read_refreshed, refresh_silver
from . import scoring
from .corpus import ensure_index, retrieve, update_index
from .encounters import encounters
from .medallion import run_gold, run_silver, truncate_patients

AS_OF = "2001-06-30"
#: A small forest written by hand, as (tree, node, left, right, feature, threshold).
#: Its weights are counted from the patients, so SQL can repeat what is built on it.
RULES = [
    (0, 0, 1, 2, "age", 59.5),
    (0, 1, 3, 4, "length_of_stay_days", 6.5),
    (0, 2, 5, 6, "sex_M", 0.5),
    (0, 3, -1, -1, None, None),
    (0, 4, -1, -1, None, None),
    (0, 5, -1, -1, None, None),
    (0, 6, 7, 8, "age", 74.5),
    (0, 7, -1, -1, None, None),
    (0, 8, -1, -1, None, None),
    (1, 0, 1, 2, "length_of_stay_days", 7.5),
    (1, 1, 3, 4, "length_of_stay_days", 2.5),
    (1, 2, 5, 6, "age", 49.5),
    (1, 3, -1, -1, None, None),
    (1, 4, -1, -1, None, None),
    (1, 5, -1, -1, None, None),
    (1, 6, -1, -1, None, None),
    (2, 0, 1, 2, "sex_F", 0.5),
    (2, 1, -1, -1, None, None),
    (2, 2, 3, 4, "age", 69.5),
    (2, 3, -1, -1, None, None),
    (2, 4, -1, -1, None, None),
]
#: Buckets of the tables that the queries keep up to date; each is a file or more.
BUCKETS = 16
#: Share of the lists that the probed search reads: unclustered vectors need many.
PROBED_SHARE = 0.6


def for_comparison(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so that both engines print them alike."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    as_text = [f.name for f in df.schema if isinstance(f.dataType, kinds)]
    return df.withColumns({c: F.col(c).cast("string") for c in as_text})


# --- shared inputs -------------------------------------------------------------


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_to_silver(encounters(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_gold(silver(spark, sf_dir), mrn_is_unique=True)[0]


_stored: dict[tuple[str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, str(sf_dir)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored patient table, written once per data folder and application."""
    key = _once(spark, sf_dir)
    if key not in _stored:
        path = scratch_path(spark, "patient")
        save_table(with_ids(None, settle(gold(spark, sf_dir))), path)
        _stored[key] = path
    return read_table(spark, _stored[key]).drop("created_at")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def found_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as search hits: three neighbours share a PMID."""
    return documents(spark, sf_dir).select(
        F.floor(F.col("doc_id") / 3).cast("string").alias("pmid"),
        F.concat(F.lit("Document "), F.col("doc_id")).alias("title"),
        F.col("text").alias("abstract"),
        F.col("lang").alias("journal"),
        (1990 + F.col("doc_id") % 30).cast("string").alias("year"),
        F.array("source", "lang").alias("authors"),
        F.col("source").alias("query"),
        F.regexp_replace("source", "[^0-9]", "").try_cast("int").alias("query_no"),
        F.col("doc_id").alias("position"),
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one abstract each."""
    return found_articles(spark, sf_dir).select(
        F.col("position").cast("string").alias("pmid"),
        "title",
        "abstract",
        "journal",
        "year",
        "authors",
        "query",
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def fingerprint(df: DataFrame, *more) -> DataFrame:
    """Whole texts as length and digest, beside further columns."""
    return df.select(
        "pmid",
        "title",
        F.length("abstract").cast("long").alias("abstract_chars"),
        F.md5(F.col("abstract").cast("binary")).alias("abstract_md5"),
        "journal",
        "year",
        F.array_join("authors", "|").alias("authors"),
        *more,
    )


_trained: dict[tuple, TrainingResult] = {}


def trained(spark: SparkSession, sf_dir: str, **settings) -> TrainingResult:
    """One full forest per data folder and application, shared by the queries below."""
    key = (*_once(spark, sf_dir), *settings.items())
    if key not in _trained:
        _trained[key] = train_model(
            patients(spark, sf_dir), scratch_path(spark, "model"), **settings
        )
    return _trained[key]


def ruled_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest of RULES with the weights of the stored patients."""
    key = _once(spark, sf_dir)
    if key not in _ruled:
        rows = patients(spark, sf_dir)
        features = patients_to_features(rows)
        values = F.array(*[F.col(quoted(n)).cast("double") for n in feature_names()])
        nodes = with_stats(
            rule_nodes(spark, RULES, feature_names()),
            features.select(values.alias("values"), LABEL),
            class_weights(rows, LABEL),
            LABEL,
        )
        _ruled[key] = scratch_path(spark, "nodes")
        save_table(nodes, _ruled[key])
    return read_table(spark, _ruled[key])


_ruled: dict[tuple, str] = {}


# --- ingest --------------------------------------------------------------------


def _raw_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "raw")
    raw = project_patient(encounters(spark, sf_dir))
    raw.write.option("header", True).csv(path)
    return path


def _bronze_rows(bronze: DataFrame) -> DataFrame:
    return for_comparison(
        bronze.select(
            *PATIENT_COLUMNS,
            F.col("source_file").endswith(".csv").alias("from_csv"),
            F.col("ingested_at").isNotNull().alias("has_time"),
        )
    )


def bronze_roundtrip(spark, sf_dir):
    out = scratch_path(spark, "bronze")
    ingest_raw_csv(spark, _raw_csv(spark, sf_dir), out)
    return _bronze_rows(read_bronze(spark, out))


def bronze_append_twice(spark, sf_dir):
    raw, out = _raw_csv(spark, sf_dir), scratch_path(spark, "bronze")
    for _ in range(2):
        ingest_raw_csv(spark, raw, out, mode="append")
    ignored = ingest_raw_csv(spark, raw, out, mode="ignore")
    return read_bronze(spark, out).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(ignored).cast("long").alias("ignored")
    )


def bronze_incremental(spark, sf_dir):
    raw, out, log = (
        _raw_csv(spark, sf_dir),
        scratch_path(spark, "bronze"),
        scratch_path(spark, "files"),
    )
    ingest_new_files(spark, raw, out, log)
    ingest_new_files(spark, raw, out, log)
    return _bronze_rows(read_bronze(spark, out))


def redacted_urls(spark, sf_dir):
    """Connection addresses made of the pages' ids, without their passwords."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    secret = F.md5(F.col("page_id").cast("string").cast("binary"))
    user = F.when(F.col("page_id") % 3 == 0, F.lit("app@")).otherwise(F.concat(F.lit("app:p@"), secret, F.lit("@")))
    url = F.concat(F.lit("postgresql://"), user, F.lit("db/care"), F.col("page_id"))
    return pages.select("page_id", redacted(url).alias("shown"))


def csv_inferred(spark, sf_dir):
    """Types found by inference; the empty texts of a CSV are nulls."""
    return read_csv(spark, f"{_raw_csv(spark, sf_dir)}/*.csv").groupBy("sex").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("age").cast("long").alias("total_age"),
        F.count_if("readmitted_30d").alias("n_readmitted"),
        F.count("primary_diagnosis").alias("n_diagnosed"),
        F.max("admission_date").cast("string").alias("last_admission"),
    )


def medallion_run(spark, sf_dir):
    """CSV files to the patient table through all three jobs.

    The files of one run share an ingest time, so their names decide which row
    of a patient is kept; only counts that do not depend on names are reported.
    """
    bronze, clean, table, rest = (
        scratch_path(spark, n) for n in ("bronze", "silver", "gold", "quarantine")
    )
    rows = ingest_raw_csv(spark, _raw_csv(spark, sf_dir), bronze)
    counts = run_silver(spark, bronze, clean)
    loaded = run_gold(spark, clean, table, quarantine_path=rest)
    quarantined = F.coalesce(F.sum("copies"), F.lit(0))
    return read_table(spark, rest).agg(
        F.lit(rows).cast("long").alias("bronze_rows"),
        F.lit(counts.rows_out).cast("long").alias("silver_rows"),
        F.lit(counts.dropped).cast("long").alias("silver_dropped"),
        (quarantined + loaded).cast("long").alias("gold_and_quarantine"),
    )


def silver_clean(spark, sf_dir):
    return for_comparison(silver(spark, sf_dir))


def silver_incremental(spark, sf_dir):
    """Silver after its bronze files came in batches of one, the last of them twice."""
    bronze, clean, log = (scratch_path(spark, n) for n in ("bronze", "silver", "files"))
    rows = encounters(spark, sf_dir)
    months = F.month("admission_date")
    for part in range(3):  # three loads, each of which holds rows of all years
        save_table(rows.where(months % 3 == part).coalesce(2), bronze)
        refresh_silver(spark, bronze, clean, log, max_files_per_batch=1, buckets=BUCKETS)
    merge_batch(rows.where(months % 3 == 1), clean)
    return for_comparison(read_refreshed(spark, clean))


def silver_drop_counts(spark, sf_dir):
    """Counts of the silver job, as the writing job reports them."""
    bronze, clean = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    save_table(encounters(spark, sf_dir), bronze)
    counts = run_silver(spark, bronze, clean)
    return read_table(spark, clean).agg(
        F.lit(counts.rows_in).cast("long").alias("bronze_rows"),
        F.count(F.lit(1)).alias("silver_rows"),
        F.lit(counts.dropped).cast("long").alias("dropped"),
    )


def gold_accept(spark, sf_dir):
    return for_comparison(split_gold(silver(spark, sf_dir))[0])


def _with_reason_text(rejected: DataFrame) -> DataFrame:
    return rejected.withColumn(REASONS, F.array_join(REASONS, ","))


def gold_reject(spark, sf_dir):
    return for_comparison(_with_reason_text(split_gold(silver(spark, sf_dir))[1]))


def _unmerged(spark, sf_dir):
    return (
        encounters(spark, sf_dir)
        .transform(drop_missing_mrn)
        .transform(validate_age)
        .transform(normalize_sex)
    )


def gold_accept_repeated(spark, sf_dir):
    return for_comparison(split_gold(_unmerged(spark, sf_dir))[0])


def gold_reject_repeated(spark, sf_dir):
    rejected = _with_reason_text(split_gold(_unmerged(spark, sf_dir))[1])
    return rejected.groupBy(REASONS).agg(F.sum("copies").cast("long").alias("n_rows"))


def lineage(spark, sf_dir):
    return for_comparison(patient_lineage(silver(spark, sf_dir)))


# --- lookups and cohorts -------------------------------------------------------


def patient_table(spark, sf_dir):
    return for_comparison(patients(spark, sf_dir))


def patient_count(spark, sf_dir):
    return patients(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_patients"))


def id_lookup(spark, sf_dir):
    return for_comparison(cohorts.find_by_id(patients(spark, sf_dir), 7))


def mrn_lookup(spark, sf_dir):
    found = cohorts.find_by_mrn(patients(spark, sf_dir), "MRN-00000042")
    return for_comparison(found.drop("id"))


def admissions_between(spark, sf_dir):
    return for_comparison(
        cohorts.admissions_between(patients(spark, sf_dir), "2000-01-01", "2000-12-31")
    )


def admissions_by_month(spark, sf_dir):
    """The same kind of range on a table laid out by month: two months are read."""
    clean, table = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    save_table(silver(spark, sf_dir), clean)
    run_gold(spark, clean, table, by_month=True)
    found = cohorts.admissions_between(
        read_table(spark, table), "1999-03-10", "1999-04-20"
    )
    return for_comparison(found.drop("created_at"))


def diagnosis_filter(spark, sf_dir):
    return for_comparison(
        cohorts.find_by_diagnoses(
            patients(spark, sf_dir), ["A41.9", "N17.9"], "1996-01-01", "2001-03-31"
        )
    )


def heart_failure(spark, sf_dir):
    return for_comparison(cohorts.heart_failure_cohort(patients(spark, sf_dir)))


def cardiovascular(spark, sf_dir):
    return for_comparison(
        cohorts.cardiovascular_cohort(patients(spark, sf_dir), start="1998-01-01")
    )


def recent(spark, sf_dir):
    return for_comparison(
        cohorts.recent_admissions(patients(spark, sf_dir), days=90, as_of=AS_OF)
    )


def elderly(spark, sf_dir):
    return for_comparison(cohorts.elderly_cohort(patients(spark, sf_dir), as_of=AS_OF))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def cohort_summary(spark, sf_dir):
    summary = cohorts.summarize_named_cohorts(silver(spark, sf_dir), AS_OF)
    return _rounded(summary, "readmit_rate")


def single_cohort_summary(spark, sf_dir):
    cohort = cohorts.named_cohort(patients(spark, sf_dir), "copd")
    return _rounded(cohorts.summarize_cohort("copd", cohort), "readmit_rate")


def readmit_rate(spark, sf_dir):
    return _rounded(cohorts.readmission_rate(patients(spark, sf_dir)), "readmit_rate")


# --- mutations -----------------------------------------------------------------


def _stored_and_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    rows = patients(spark, sf_dir).drop("id")
    stored = with_ids(None, rows.filter(F.col("admission_date") < "2001-01-01"))
    return stored, rows.filter(F.col("admission_date") >= "2000-01-01")


def insert_unique(spark, sf_dir):
    stored, batch = _stored_and_batch(spark, sf_dir)
    inserted = with_ids(stored, new_patients(stored, batch))
    return for_comparison(inserted.drop("created_at"))


def insert_conflicts(spark, sf_dir):
    """By way of the Bloom filter, which a batch of this size would not need."""
    return duplicate_mrns(*_stored_and_batch(spark, sf_dir), limit=-1)


def gold_append(spark, sf_dir):
    """The gold table after a second load that overlaps the first: ids go on densely,
    patients known already are refused."""
    early, late, table = (scratch_path(spark, n) for n in ("silver", "silver", "gold"))
    rows = silver(spark, sf_dir)
    save_table(rows.where("admission_date < '2001-01-01'"), early)
    save_table(rows.where("admission_date >= '2000-01-01'"), late)
    run_gold(spark, early, table)
    run_gold(spark, late, table, mode="append")
    return for_comparison(
        read_table(spark, table).withColumn("created_at", F.col("created_at").isNotNull())
    ).withColumnRenamed("created_at", "has_time")


def truncated_table(spark, sf_dir):
    """A gold table that was truncated and loaded again: ids start at 1 once more."""
    clean, table = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    save_table(silver(spark, sf_dir), clean)
    run_gold(spark, clean, table)
    truncate_patients(spark, table)
    empty = read_table(spark, table).count()
    run_gold(spark, clean, table, mode="append")
    return read_table(spark, table).agg(
        F.lit(empty).cast("long").alias("n_after_truncate"),
        F.count(F.lit(1)).alias("n_loaded"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


def delete_ids(spark, sf_dir):
    rows = patients(spark, sf_dir)
    palliative = cohorts.find_by_diagnoses(rows, ["Z51.5"])
    return for_comparison(delete_by_ids(rows, palliative))


# --- features and model inputs -------------------------------------------------


def feature_matrix(spark, sf_dir):
    features = patients_to_features(gold(spark, sf_dir), keep=["mrn"])
    plain = [F.col(quoted(n)).alias(n.replace(".", "_")) for n in feature_names()]
    return features.select("mrn", *plain, LABEL)


def unknown_diagnosis_counts(spark, sf_dir):
    rows = gold(spark, sf_dir)
    unknown = patients_to_features(rows, keep=["primary_diagnosis"]).filter(
        F.col("dx_UNKNOWN") == 1
    )
    return unknown.groupBy(
        F.coalesce("primary_diagnosis", F.lit("(null)")).alias("diagnosis")
    ).agg(F.count(F.lit(1)).alias("n_patients"))


def request_accept(spark, sf_dir):
    requests = encounters(spark, sf_dir).select(*REQUEST_COLUMNS)
    return for_comparison(split_requests(requests)[0])


def request_reject(spark, sf_dir):
    requests = encounters(spark, sf_dir).select(*REQUEST_COLUMNS)
    rejected = _with_reason_text(split_requests(requests)[1])
    return rejected.groupBy(REASONS).agg(F.count(F.lit(1)).alias("n_rows"))


def label_split(spark, sf_dir):
    """Labels as numbers, apart from the features."""
    features, labels = split_features_label(patients_to_features(gold(spark, sf_dir)))
    if features.columns != feature_names():
        raise ValueError(f"features are {features.columns}")
    return labels.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n_rows"))


def request_positions(spark, sf_dir):
    """Requests read from several files, scored, with their place in the input."""
    path = scratch_path(spark, "requests")
    dealt = encounters(spark, sf_dir).repartitionByRange(5, "source_file").sortWithinPartitions("source_file")
    dealt.select(*REQUEST_COLUMNS).write.option("header", True).csv(path)
    schema = encounters(spark, sf_dir).select(*REQUEST_COLUMNS).schema
    requests = with_positions(spark.read.schema(schema).option("header", True).csv(path))
    scored = scoring.predict_by_rows(requests, ruled_nodes(spark, sf_dir), keep=["position"])[0]
    return _rounded(scored, "readmission_probability")


def split_rows(spark, sf_dir):
    return stratified_split(
        gold(spark, sf_dir).select("mrn", LABEL), "mrn", LABEL
    )


def weights(spark, sf_dir):
    return _rounded(class_weights(gold(spark, sf_dir), LABEL), "class_weight")


def label_rate(spark, sf_dir):
    return _rounded(positive_rate(gold(spark, sf_dir), LABEL), "positive_rate")


def metrics_of_age(spark, sf_dir):
    scored = gold(spark, sf_dir).select(F.col("age").alias("score"), LABEL)
    return _rounded(
        binary_metrics(scored, "score", LABEL, threshold=65),
        "auc",
        "precision",
        "recall",
        "average_precision",
    )


def risk_bands(spark, sf_dir):
    p = F.col("age") / F.lit(200.0)
    return gold(spark, sf_dir).select(
        "mrn",
        risk_band(p).alias("risk_band"),
        predicted_label(p, 0.3).alias("predicted_label"),
        percent(p).alias("percent"),
    )


def _made_contributions(spark, sf_dir) -> DataFrame:
    """Contributions by a fixed rule, to check their ranking."""
    features = patients_to_features(gold(spark, sf_dir), False, keep=["mrn"])
    entries = [
        F.struct(
            F.lit(n).alias("feature_name"),
            F.col(quoted(n)).cast("double").alias("feature_value"),
            (((F.col(quoted(n)) * 37 + i * 11) % 23 - 11) / F.lit(10.0)).alias("shap_value"),
        )
        for i, n in enumerate(feature_names())
    ]
    return features.select("mrn", F.array(*entries).alias("contributions"))


def ranked_contributions(spark, sf_dir):
    top = _made_contributions(spark, sf_dir).select(
        "mrn", F.posexplode(top_contributions(F.col("contributions"), 5))
    )
    return top.select("mrn", (F.col("pos") + 1).alias("rank"), "col.*")


def contribution_signs(spark, sf_dir):
    c = F.col("contributions")
    return _made_contributions(spark, sf_dir).select(
        "mrn",
        F.size(positive_contributions(c)).alias("n_positive"),
        F.size(negative_contributions(c)).alias("n_negative"),
    )


# --- model ---------------------------------------------------------------------


def training_report(spark, sf_dir):
    """Sizes, and whether metrics and importances agree with a second computation: the
    library's own AUC, and importances from the node rows."""
    result = trained(spark, sf_dir)
    model = load_model(spark, result.model_path)
    rows = patients(spark, sf_dir)
    split = stratified_split(rows.select("mrn", LABEL), "mrn", LABEL).where("is_test").select("mrn")
    test = patients_to_features(rows.join(split, "mrn", "left_semi"), keep=["mrn"])
    scored = predict_proba(test, model, keep=["mrn", LABEL])
    scored = scored.select(F.col("probability"), F.col(LABEL).cast("double").alias("label"))
    auc = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0).evaluate(scored)
    by_rows = importance_by_name(read_nodes(spark, result.model_path), feature_names())
    near = all(abs(by_rows[n] - v) < 1e-6 for n, v in result.feature_importance.items())
    return gold(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_patients"),
        F.lit(result.n_train).cast("long").alias("n_train"),
        F.lit(result.n_test).cast("long").alias("n_test"),
        F.lit(abs(auc - result.auc) < 1e-6).alias("auc_agrees"),
        F.lit(near).alias("importances_agree"),
    )


def top_features(spark, sf_dir):
    """Largest importances of the forest of RULES, with each feature's mean."""
    top = top_importances(importance_by_name(ruled_nodes(spark, sf_dir), feature_names()))
    means = patients_to_features(patients(spark, sf_dir), False).agg(
        *[F.avg(F.col(quoted(n)).cast("double")).alias(f"m{i}") for i, (n, _) in enumerate(top)]
    )
    rows = [
        F.struct(
            F.lit(i + 1).alias("rank"),
            F.lit(n).alias("feature_name"),
            F.lit(v).alias("importance"),
            F.col(f"m{i}").alias("mean_value"),
        )
        for i, (n, v) in enumerate(top)
    ]
    return _rounded(means.select(F.inline(F.array(*rows))), "importance", "mean_value")


def forest_scores(spark, sf_dir):
    """All patients scored by the node rows of the forest of RULES."""
    scored = scoring.predict_by_rows(patients(spark, sf_dir), ruled_nodes(spark, sf_dir))[0]
    return _rounded(scored, "readmission_probability")


def batch_mean(spark, sf_dir):
    """Size and mean of a scored batch, as its writing job reports them."""
    scored, _ = scoring.predict_by_rows(patients(spark, sf_dir), ruled_nodes(spark, sf_dir))
    observed, seen = scoring.with_batch_mean(scored)
    path = scratch_path(spark, "scores")
    observed.write.parquet(path)
    return read_table(spark, path).groupBy("risk_band").agg(
        F.count(F.lit(1)).alias("n_in_band"),
        F.lit(seen.get["n_scored"]).cast("long").alias("n_scored"),
        F.lit(round(seen.get["mean_probability"], 6)).alias("mean_probability"),
    )


def trained_scores(spark, sf_dir):
    model = load_model(spark, trained(spark, sf_dir).model_path)
    return scoring.predict(patients(spark, sf_dir), model)[0]


def score_checks(spark, sf_dir):
    """The trained forest's scores against a walk over its node rows."""
    nodes = read_nodes(spark, trained(spark, sf_dir).model_path)
    walked = scoring.predict_by_rows(patients(spark, sf_dir), nodes)[0]
    walked = walked.select("mrn", F.col("readmission_probability").alias("p"), F.col("risk_band").alias("band"))
    near = F.abs(F.col("p") - F.col("readmission_probability")) < 1e-9
    return trained_scores(spark, sf_dir).join(walked, "mrn").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(near).alias("n_same_score"),
        F.count_if((F.col("band") == F.col("risk_band")) | near).alias("n_same_band"),
    )


def label_checks(spark, sf_dir):
    """The trained forest's labels at a threshold against the walk over its node rows."""
    result = trained(spark, sf_dir)
    features = patients_to_features(patients(spark, sf_dir), False, keep=["mrn"])
    labelled = predict_label(features, load_model(spark, result.model_path), 0.4, keep=["mrn"])
    walked = score_features(features, read_nodes(spark, result.model_path), feature_names(), ["mrn"])
    expected = (F.round("p", 9) >= 0.4).cast("int")
    walked = walked.select("mrn", F.col("probability").alias("p"))
    return labelled.join(walked, "mrn").agg(
        F.count(F.lit(1)).alias("n_labelled"),
        F.count_if((F.col("predicted_label") == expected) | (F.abs(F.col("p") - 0.4) < 1e-9)).alias("n_at_threshold"),
    )


def tree_shap(spark, sf_dir):
    """Contributions to the scores of ``forest_scores``."""
    explainer = Explainer(spark, nodes=ruled_nodes(spark, sf_dir))
    explained = scoring.explain(patients(spark, sf_dir), explainer)[0].select(
        "mrn", "predicted_probability", "baseline_probability", F.inline("contributions")
    )
    return _rounded(explained, "predicted_probability", "baseline_probability", "shap_value")


def shap_checks(spark, sf_dir):
    """The trained forest's contributions add up to its own library's scores."""
    explainer = Explainer(spark, trained(spark, sf_dir).model_path)
    total = F.aggregate(
        "contributions", F.lit(0.0), lambda s, c: s + c["shap_value"]
    )
    explained = scoring.explain(patients(spark, sf_dir), explainer)[0].select(
        "mrn", "predicted_probability", (total + F.col("baseline_probability")).alias("total"), F.size("contributions").alias("n")
    )
    scored = trained_scores(spark, sf_dir).select("mrn", "readmission_probability")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-6
    return explained.join(scored, "mrn").agg(
        F.count(F.lit(1)).alias("n_explained"),
        F.count_if(near("total", "readmission_probability")).alias("n_additive"),
        F.count_if(near("predicted_probability", "readmission_probability")).alias("n_same_score"),
        F.sum("n").cast("long").alias("n_contributions"),
    )


def _points(spark, sf_dir) -> DataFrame:
    """Documents as index points."""
    abstracts = corpus(spark, sf_dir).withColumns(
        {
            "point_id": point_id(F.col("pmid")),
            "_text": embedding_text(F.col("title"), F.col("abstract")),
        }
    )
    return digest_embedder()(abstracts, "_text", "vector").drop("_text")


def article_index(spark, sf_dir) -> InvertedIndex:
    """The documents' inverted index, written once per data folder and application."""
    key = _once(spark, sf_dir)
    if key not in _indexed:
        _indexed[key] = scratch_path(spark, "articles")
        # the build reads its rows three times: embed them once
        build_index(settle(_points(spark, sf_dir)), _indexed[key])
    return InvertedIndex(spark, _indexed[key])


_indexed: dict[tuple, str] = {}


def _cited(spark, sf_dir) -> DataFrame:
    explainer = Explainer(spark, nodes=ruled_nodes(spark, sf_dir))
    return scoring.explain_with_citations(
        patients(spark, sf_dir), explainer, article_index(spark, sf_dir), embedder=digest_embedder()
    )[0]


def cited_explanations(spark, sf_dir):
    cited = _cited(spark, sf_dir).select(
        "mrn",
        "predicted_probability",
        "risk_band",
        "query",
        F.posexplode_outer("citations").alias("position", "citation"),
    )
    cited = cited.select("mrn", "predicted_probability", "risk_band", "query", "position", "citation.*")
    return _rounded(cited.drop("authors"), "predicted_probability", "score")


def citation_checks(spark, sf_dir):
    scores = F.col("citations")["score"]
    return _cited(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_explained"),
        F.countDistinct("query").alias("n_queries"),
        F.sum(F.size("citations")).cast("long").alias("n_citations"),
        F.count_if(scores == F.reverse(F.array_sort(scores))).alias("n_in_score_order"),
    )


# --- literature ----------------------------------------------------------------


def clinical_queries(spark, sf_dir):
    return gold(spark, sf_dir).select(
        "mrn",
        clinical_query(
            F.col("age"),
            F.col("admission_date"),
            F.col("discharge_date"),
            F.col("primary_diagnosis"),
        ).alias("query"),
    )


def article_xml(spark, sf_dir):
    """Documents written as article XML and parsed back; French has no abstract."""
    text = F.regexp_replace("text", "[\\x00-\\x1f\\x7f]", " ")
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(entity))
    article = F.format_string(
        "<PubmedArticle><MedlineCitation><PMID>%d</PMID><Article>"
        "<Journal><JournalIssue><PubDate><Year>%s</Year></PubDate></JournalIssue>"
        "<Title>Journal %s</Title></Journal><ArticleTitle>Document %d</ArticleTitle>"
        "%s<AuthorList><Author><LastName>%s</LastName><Initials>%s</Initials></Author>"
        "<Author><LastName/></Author></AuthorList>"
        "</Article></MedlineCitation></PubmedArticle>",
        "doc_id",
        (1990 + F.col("doc_id") % 30).cast("string"),
        "lang",
        "doc_id",
        F.when(F.col("lang") == "fr", "").otherwise(
            F.concat(
                F.lit('<Abstract><AbstractText Label="TEXT">'),
                text,
                F.lit("</AbstractText><AbstractText>from <i>source</i> "),
                F.col("source"),
                F.lit("</AbstractText></Abstract>"),
            )
        ),
        "source",
        F.upper("lang"),
    )
    path = scratch_path(spark, "articles")
    documents(spark, sf_dir).select(article.alias("value")).write.text(path)
    return fingerprint(read_article_xml(spark, path))


def corpus_array(spark, sf_dir):
    """The documents through files that hold one JSON array each."""
    path = scratch_path(spark, "corpus")
    rows = corpus(spark, sf_dir)
    # a file per partition of the table, so that their number grows with it
    texts = rows.select(F.to_json(F.struct(*ABSTRACT_SCHEMA.names), {"ignoreNullFields": "false"}).alias("value"))

    def one_array(batches):
        mark = "["
        for batch in batches:
            for text in batch["value"].to_pylist():
                yield pa.RecordBatch.from_pydict({"value": [mark + text]})
                mark = ","
        yield pa.RecordBatch.from_pydict({"value": ["[]" if mark == "[" else "]"]})

    texts.mapInArrow(one_array, "value string").write.text(path)
    return fingerprint(read_corpus(spark, path, array_file=True))


def corpus_json(spark, sf_dir):
    path = scratch_path(spark, "corpus")
    write_corpus(corpus(spark, sf_dir), path)
    return fingerprint(read_corpus(spark, path))


def corpus_first_wins(spark, sf_dir):
    return fingerprint(first_query_wins(found_articles(spark, sf_dir)), "query")


def corpus_new(spark, sf_dir):
    found = found_articles(spark, sf_dir)
    english = found.filter(F.col("journal") == "en")
    return fingerprint(new_articles(english, first_query_wins(found)))


def distinct_pmids(spark, sf_dir):
    return found_articles(spark, sf_dir).agg(F.countDistinct("pmid").alias("n_pmids"))


def corpus_upsert(spark, sf_dir):
    found = found_articles(spark, sf_dir)
    stored = first_query_wins(found.filter(F.col("query_no") < 10))
    batch = found.filter(F.col("query_no") >= 5).withColumn(
        "_order", F.col("query_no") * F.lit(10**12) + F.col("position")
    )
    return fingerprint(
        upsert(stored.drop("query_no", "position"), batch.drop("query_no", "position"), "pmid", "_order")
    )


def _entries_twice(spark, sf_dir) -> DataFrame:
    """Documents as corpus entries; three neighbours share a PMID."""
    return corpus(spark, sf_dir).withColumn("pmid", F.floor(F.col("pmid").cast("long") / 3).cast("string"))


def _index_loads(spark, sf_dir) -> tuple[str, int, int]:
    """An index after two loads: all documents, each file in id order, then the English
    ones under other titles. Returns its path and the articles read."""
    index = scratch_path(spark, "index")
    entries = _entries_twice(spark, sf_dir)
    first, second = scratch_path(spark, "corpus"), scratch_path(spark, "corpus")
    in_order = entries.withColumn("_id", F.regexp_extract("title", r"(\d+)", 1).cast("long"))
    # entries of one PMID are written to one file, in the order of their ids
    dealt = in_order.repartition("pmid").sortWithinPartitions("_id")
    write_corpus(dealt, first)
    write_corpus(dealt.where("journal = 'en'").withColumn("title", F.concat(F.lit("New "), "title")), second)
    return index, update_index(spark, first, index, buckets=BUCKETS), update_index(spark, second, index)


def index_snapshots(spark, sf_dir):
    """Points after two loads whose corpora name a PMID more than once: of each load
    the last entry stays, the second load replaces the first."""
    index, *_ = _index_loads(spark, sf_dir)
    return read_table(spark, index).select(
        "point_id",
        "pmid",
        F.md5(F.col("title").cast("binary")).alias("title_md5"),
        F.md5(F.col("abstract").cast("binary")).alias("abstract_md5"),
        F.size("vector").cast("long").alias("dim"),
    )


def index_created(spark, sf_dir):
    """An index that is created once, however often it is asked for, and then filled."""
    path, corpus_path = scratch_path(spark, "index"), scratch_path(spark, "corpus")
    created = [ensure_index(spark, path, BUCKETS), ensure_index(spark, path, BUCKETS)]
    write_corpus(corpus(spark, sf_dir), corpus_path)
    update_index(spark, corpus_path, path)
    return read_table(spark, path).agg(
        F.lit(sum(created)).cast("long").alias("n_created"), F.count(F.lit(1)).alias("n_points")
    )


def index_loads(spark, sf_dir):
    """How many articles the two loads read, and that none was added twice."""
    index, first, second = _index_loads(spark, sf_dir)
    return read_table(spark, index).agg(
        F.lit(first).cast("long").alias("n_first"),
        F.lit(second).cast("long").alias("n_second"),
        F.count(F.lit(1)).alias("n_points"),
        F.countDistinct("point_id").alias("n_ids"),
    )


def point_ids(spark, sf_dir):
    pmid = F.when(F.col("lang") == "de", F.concat(F.lit("PMC"), F.col("doc_id"))).otherwise(
        F.col("doc_id").cast("string")
    )
    return documents(spark, sf_dir).select(
        "doc_id", F.coalesce(point_id(pmid), F.lit(-1)).alias("point_id")
    )


def embedding_texts(spark, sf_dir):
    text = embedding_text(
        F.col("title"), F.when(F.col("journal") != "es", F.col("abstract"))
    )
    return corpus(spark, sf_dir).select(
        "pmid",
        F.length(text).cast("long").alias("n_chars"),
        F.md5(text.cast("binary")).alias("text_md5"),
    )


def payload_defaults(spark, sf_dir):
    partial = corpus(spark, sf_dir).select(
        "pmid",
        F.when(F.col("journal") != "en", F.col("title")).alias("title"),
        "abstract",
        F.when(F.col("journal") != "de", F.col("authors")).alias("authors"),
    )
    url = citation_url(F.col("pmid")).alias("pubmed_url")
    return fingerprint(fill_payload(partial), "score", url)


def rounded_half_up(x: Column) -> Column:
    """What ``round`` gives as a whole number, without its decimal arithmetic per value."""
    size = F.abs(x)
    whole = F.floor(size)
    up = whole + F.when(size - whole >= 0.5, 1).otherwise(0)
    return F.when(x < 0, -up).otherwise(up).cast("long")


def text_embedding(spark, sf_dir):
    """The numbers of every document's vector that are not zero, in millionths."""
    embedded = digest_embedder()(documents(spark, sf_dir), "text", "vector")
    spread = embedded.select("doc_id", F.posexplode("vector")).where("col != 0")
    return spread.select("doc_id", F.col("pos").alias("place"), rounded_half_up(F.col("col").cast("double") * 1e6).alias("millionths"))


def embedding_checks(spark, sf_dir):
    """The embedder of the JVM: size and length."""
    embedded = hashed_embedder()(documents(spark, sf_dir), "text", "vector")
    return embedded.select(
        "doc_id",
        F.size("vector").alias("dim"),
        F.round(l2_norm(F.col("vector")), 4).alias("norm"),
    )


def normalized_vectors(spark, sf_dir):
    raw = F.transform("embedding", lambda x, i: x.cast("double") * 3 + i)
    unit = normalize(raw)
    return embeddings(spark, sf_dir).select(
        "vec_id",
        F.round(l2_norm(unit), 6).alias("norm"),
        F.round(F.aggregate(unit, F.lit(0.0), lambda s, x: s + x), 4).alias("total"),
    )


def cosine_to_first_of_label(spark, sf_dir):
    vectors = embeddings(spark, sf_dir)
    first = vectors.groupBy("label").agg(
        F.min_by("embedding", "vec_id").alias("first_embedding")
    )
    return vectors.join(first, "label").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("first_embedding")), 4).alias("score")
    )


def _vectors(spark, sf_dir, key: str) -> DataFrame:
    return embeddings(spark, sf_dir).select(F.col("vec_id").alias(key), F.col("embedding").alias("vector"))


def knn_top3(spark, sf_dir):
    near = top_k(_vectors(spark, sf_dir, "query_key"), _vectors(spark, sf_dir, "document_key"), 3)
    return near.withColumn("score", F.round("score", 4))


_vector_indexes: dict[tuple, str] = {}


def vector_index(spark, sf_dir) -> InvertedIndex:
    key = _once(spark, sf_dir)
    if key not in _vector_indexes:
        _vector_indexes[key] = scratch_path(spark, "vectors")
        build_index(embeddings(spark, sf_dir), _vector_indexes[key], "vec_id", "embedding")
    return InvertedIndex(spark, _vector_indexes[key], "vec_id", "embedding")


def _probed_top3(spark, sf_dir) -> DataFrame:
    index = vector_index(spark, sf_dir)
    probes = ceil(PROBED_SHARE * len(index.centroids))
    return index.search(_vectors(spark, sf_dir, "query_key"), 3, probes)


def indexed_top3(spark, sf_dir):
    """The three best rows of the lists that a query probes."""
    return _rounded(_probed_top3(spark, sf_dir), "score")


def indexed_top3_exact(spark, sf_dir):
    """The three best of all rows, by the lists that the bounds leave."""
    found = vector_index(spark, sf_dir).search(_vectors(spark, sf_dir, "query_key"), 3, exact=True)
    return found.withColumn("score", F.round("score", 4))


def index_recall(spark, sf_dir):
    """How much of ``knn_top3`` the probed lists hold."""
    exact = top_k(_vectors(spark, sf_dir, "query_key"), _vectors(spark, sf_dir, "document_key"), 3)
    return _rounded(recall(_probed_top3(spark, sf_dir), exact), "recall")


def retrieved_documents(spark, sf_dir):
    """The clinical queries of all patients against all documents."""
    found = retrieve(clinical_queries(spark, sf_dir), article_index(spark, sf_dir), embedder=digest_embedder())
    return _rounded(found.drop("abstract", "authors"), "score")


QUERIES = {
    f.__name__: f
    for f in (
        bronze_roundtrip,
        bronze_append_twice,
        bronze_incremental,
        redacted_urls,
        csv_inferred,
        medallion_run,
        silver_clean,
        silver_incremental,
        silver_drop_counts,
        gold_accept,
        gold_reject,
        gold_accept_repeated,
        gold_reject_repeated,
        lineage,
        patient_table,
        patient_count,
        id_lookup,
        mrn_lookup,
        admissions_between,
        admissions_by_month,
        diagnosis_filter,
        heart_failure,
        cardiovascular,
        recent,
        elderly,
        cohort_summary,
        single_cohort_summary,
        readmit_rate,
        insert_unique,
        insert_conflicts,
        gold_append,
        truncated_table,
        delete_ids,
        feature_matrix,
        unknown_diagnosis_counts,
        request_accept,
        request_reject,
        label_split,
        request_positions,
        split_rows,
        weights,
        label_rate,
        metrics_of_age,
        risk_bands,
        ranked_contributions,
        contribution_signs,
        training_report,
        top_features,
        forest_scores,
        batch_mean,
        trained_scores,
        score_checks,
        label_checks,
        tree_shap,
        shap_checks,
        cited_explanations,
        citation_checks,
        clinical_queries,
        article_xml,
        corpus_json,
        corpus_array,
        corpus_first_wins,
        corpus_new,
        distinct_pmids,
        corpus_upsert,
        index_snapshots,
        index_created,
        index_loads,
        point_ids,
        embedding_texts,
        payload_defaults,
        text_embedding,
        embedding_checks,
        normalized_vectors,
        cosine_to_first_of_label,
        knn_top3,
        indexed_top3,
        indexed_top3_exact,
        index_recall,
        retrieved_documents,
    )
}
