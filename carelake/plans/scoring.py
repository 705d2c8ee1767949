"""Batch scoring: predict, explain, and explain with citations.

Each takes scoring requests (patient columns without a label; ``keep`` names
further columns to carry through, such as an input position) and returns the
results and the rejected requests with reasons. Requests are never capped and
may repeat a patient.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.clinical import clinical_query, risk_band
from ..functions.vectors import Embedder
from ..operators.contract import scoring_rows, split_requests
from ..operators.features import feature_names, patients_to_features
from ..operators.forest import predict_proba
from ..operators.forest_rows import score_features
from ..operators.inverted_index import InvertedIndex
from ..operators.lookup import attach
from ..operators.shap import Explainer
from .corpus import retrieve

CITATION_FIELDS = ["pmid", "title", "journal", "year", "authors", "score", "pubmed_url"]
CITATIONS_TYPE = (
    "array<struct<pmid:string,title:string,journal:string,year:string,"
    "authors:array<string>,score:double,pubmed_url:string>>"
)


def predict(
    requests: DataFrame, model: PipelineModel, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Probability and band per request, in one narrow stage."""
    accepted, rejected = split_requests(requests)
    carried = ["mrn", *keep]
    rows = scoring_rows(accepted, keep)
    features = patients_to_features(rows, include_label=False, keep=carried)
    scored = predict_proba(features, model, keep=carried)
    return (
        scored.select(
            *carried,
            F.col("probability").alias("readmission_probability"),
            risk_band(F.col("probability")).alias("risk_band"),
        ),
        rejected,
    )


def predict_by_rows(
    requests: DataFrame, nodes: DataFrame, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The same by the node rows of a forest (``operators.forest_rows``)."""
    accepted, rejected = split_requests(requests)
    carried = ["mrn", *keep]
    features = patients_to_features(scoring_rows(accepted, keep), include_label=False, keep=carried)
    scored = score_features(features, nodes, feature_names(), carried)
    return (
        scored.select(
            *carried,
            F.col("probability").alias("readmission_probability"),
            risk_band(F.col("probability")).alias("risk_band"),
        ),
        rejected,
    )


def with_batch_mean(predictions: DataFrame) -> tuple[DataFrame, Observation]:
    """Count and mean probability of a batch, known once it has been written."""
    seen = Observation()
    return (
        predictions.observe(
            seen,
            F.count(F.lit(1)).alias("n_scored"),
            F.avg("readmission_probability").alias("mean_probability"),
        ),
        seen,
    )


def explain(
    requests: DataFrame, explainer: Explainer, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Probability, baseline and one contribution per feature."""
    accepted, rejected = split_requests(requests)
    rows = scoring_rows(accepted, keep)
    return _explained(rows, explainer, ["mrn", *keep]), rejected


def explain_with_citations(
    requests: DataFrame,
    explainer: Explainer,
    index: DataFrame | InvertedIndex | None = None,
    k: int = 3,
    embedder: Embedder | None = None,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Explanations with the k most similar articles; none without an index. The index
    is a table of points, compared with all of them, or a stored inverted index."""
    accepted, rejected = split_requests(requests)
    asked = scoring_rows(accepted, keep).withColumn(
        "query",
        clinical_query(
            F.col("age"),
            F.col("admission_date"),
            F.col("discharge_date"),
            F.col("primary_diagnosis"),
        ),
    )
    results = _explained(asked, explainer, ["mrn", "query", *keep]).withColumn(
        "risk_band", risk_band(F.col("predicted_probability"))
    )
    if index is None:
        cited = results.withColumn("citations", F.array().cast(CITATIONS_TYPE))
    else:
        cited = attach(results, _citations(asked, index, k, embedder), "query")
    return (
        cited.select(
            "mrn",
            *keep,
            "predicted_probability",
            "baseline_probability",
            "risk_band",
            "contributions",
            "query",
            F.coalesce("citations", F.array().cast(CITATIONS_TYPE)).alias("citations"),
        ),
        rejected,
    )


def _explained(
    accepted: DataFrame, explainer: Explainer, carried: Sequence[str]
) -> DataFrame:
    features = patients_to_features(accepted, include_label=False, keep=carried)
    rows = features.select(*carried, explainer.values_column().alias("values"))
    return attach(rows, explainer.explain_features(features), "values").select(
        *carried,
        F.col("probability").alias("predicted_probability"),
        F.lit(explainer.baseline).alias("baseline_probability"),
        explainer.contributions_column().alias("contributions"),
    )


def _citations(
    asked: DataFrame, index: DataFrame | InvertedIndex, k: int, embedder: Embedder | None
) -> DataFrame:
    """At most k articles per distinct query, in rank order."""
    found = retrieve(asked.select("query"), index, k, embedder)
    ranked = F.sort_array(F.collect_list(F.struct("rank", *CITATION_FIELDS)))
    drop_rank = lambda c: F.struct(*[c[f].alias(f) for f in CITATION_FIELDS])
    return found.groupBy("query").agg(F.transform(ranked, drop_rank).alias("citations"))
