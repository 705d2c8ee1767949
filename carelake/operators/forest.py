"""Balanced random forest: training, evaluation, storage and scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import LABEL, MIN_TRAINING_ROWS, PATIENT_COLUMNS
from ..functions.clinical import predicted_label
from ..runtime import settle
from ..sources.tables import table_exists
from .features import feature_names, patients_to_features, quoted, require_features
from .metrics import binary_metrics, class_weights
from .ranking import stratified_split

#: Rows of counted vectors in a task. A task holds the histograms of all nodes that are
#: split at once, so few tasks with many rows cost less than many with few.
ROWS_PER_TASK = 250_000
#: Trees that grow at once, if each needs one task; the driver holds the nodes of these.
TREES_AT_ONCE = 8


@dataclass(frozen=True)
class TrainingResult:
    n_train: int
    n_test: int
    auc: float | None
    precision: float
    recall: float
    average_precision: float
    feature_importance: dict[str, float]
    model_path: str


def train_model(
    patients: DataFrame,
    output_path: str,
    test_size: float = 0.2,
    random_state: int = 42,
    n_estimators: int = 100,
    max_depth: int = 30,
    max_bins: int = 128,
) -> TrainingResult:
    """Fit on a stratified part of the patients, evaluate on the rest, save.

    Each class weighs the same in total, so scores centre near one half and not
    near the base rate. Trees are as deep as the library allows unless told otherwise. 128
    bins keep every age apart; stays of more distinct lengths need more of them.

    Equal rows are counted first (see ``drawn_vectors``), so a tree's passes go over
    distinct vectors and not over patients.
    """
    found = patients.limit(MIN_TRAINING_ROWS).count()
    if found < MIN_TRAINING_ROWS:
        raise ValueError(f"need at least {MIN_TRAINING_ROWS} patients, got {found}")
    split = settle(
        stratified_split(
            patients.select(*PATIENT_COLUMNS), "mrn", LABEL, test_size, random_state
        ).sortWithinPartitions("mrn")
    )
    train = split.filter(~F.col("is_test"))
    assembler = VectorAssembler(
        inputCols=[quoted(n) for n in feature_names()], outputCol="_features"
    )
    drawn = drawn_vectors(patients_to_features(train), n_estimators, random_state)
    weighted = settle(
        assembler.transform(drawn.join(F.broadcast(class_weights(train, LABEL)), LABEL)).select(
            "_features", F.col(LABEL).cast("double").alias("_label"), "class_weight", "draws"
        )
    )

    def grown(tree: int) -> RandomForestClassificationModel:
        weight = F.col("draws")[tree] * F.col("class_weight")
        rows = weighted.select("_features", "_label", weight.alias("_weight"))
        return RandomForestClassifier(
            featuresCol="_features",
            labelCol="_label",
            weightCol="_weight",
            rawPredictionCol="_raw",
            probabilityCol="_probability",
            predictionCol="_prediction",
            numTrees=1,
            bootstrap=False,  # the draws are in the weight
            maxDepth=max_depth,
            maxBins=max_bins,
            maxMemoryInMB=256,
            featureSubsetStrategy="sqrt",
            seed=random_state + tree,
        ).fit(rows.where("_weight > 0"))

    forest = grown_together(weighted, n_estimators, grown)
    model = PipelineModel([assembler, forest])
    model.write().overwrite().save(str(output_path))
    model = load_model(patients.sparkSession, output_path)  # evaluate what was saved

    test = patients_to_features(split.filter(F.col("is_test")), keep=["mrn"])
    scored = predict_proba(test, model, keep=["mrn", LABEL])
    report = binary_metrics(scored, "probability", LABEL).first()
    return TrainingResult(
        n_train=train.count(),
        n_test=report.n,
        auc=report.auc,
        precision=report.precision,
        recall=report.recall,
        average_precision=report.average_precision,
        feature_importance=feature_importance(model),
        model_path=str(output_path),
    )


def drawn_vectors(features: DataFrame, n_draws: int, seed: int) -> DataFrame:
    """Distinct rows of ``features`` and ``draws``: how often each tree draws them.

    A bootstrap draws each row a Poisson(1) number of times, so it draws n equal rows
    Poisson(n) times together. Draws depend on a row's values, its count and the seed.
    """
    counted = settle(features.groupBy(*map(quoted, features.columns)).agg(F.count(F.lit(1)).alias("_n")))
    state = F.xxhash64(*map(quoted, features.columns))
    dealt = counted.repartition(max(1, ceil(counted.count() / ROWS_PER_TASK)))
    return dealt.withColumn("draws", poisson_draws(n_draws, seed)(state, F.col("_n"))).drop("_n")


def poisson_draws(n_draws: int, seed: int) -> Callable[[Column, Column], Column]:
    """(state, mean) to ``n_draws`` numbers, the same for the same state, mean and seed."""

    @F.pandas_udf("array<long>")
    def draws(state: pd.Series, mean: pd.Series) -> pd.Series:
        keys = state.to_numpy("int64").view("uint64")
        made = (
            np.random.Generator(np.random.Philox(key=np.array([seed % 2**64, k], "uint64"))).poisson(m, n_draws)
            for k, m in zip(keys, mean)
        )
        return pd.Series(list(made), dtype=object)

    return draws


def grown_together(
    rows: DataFrame, n_trees: int, grown: Callable[[int], RandomForestClassificationModel]
) -> RandomForestClassificationModel:
    """One forest of forests of one tree, which grow at once as far as there are cores."""
    spark = rows.sparkSession
    free = spark.sparkContext.defaultParallelism // rows.rdd.getNumPartitions()
    with ThreadPoolExecutor(max(1, min(free, TREES_AT_ONCE))) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(grown), tree) for tree in range(n_trees)]
        forests = [job.result() for job in jobs]
    ml = spark._jvm.org.apache.spark.ml.classification
    trees = spark.sparkContext._gateway.new_array(ml.DecisionTreeClassificationModel, n_trees)
    for i, forest in enumerate(forests):
        trees[i] = forest.trees[0]._java_obj
    first = forests[0]
    merged = RandomForestClassificationModel(
        ml.RandomForestClassificationModel(first.uid, trees, first.numFeatures, first.numClasses)
    )
    for param in ("featuresCol", "labelCol", "rawPredictionCol", "probabilityCol", "predictionCol"):
        merged.set(merged.getParam(param), first.getOrDefault(param))
    merged.set(merged.numTrees, n_trees)
    return merged


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not table_exists(spark, str(path)):
        raise FileNotFoundError(f"no model at {path}; train one first")
    return PipelineModel.load(str(path))


def model_features(model: PipelineModel) -> list[str]:
    """Names and order the model was trained on, from its saved metadata."""
    return [c.strip("`") for c in model.stages[0].getInputCols()]


def predict_proba(
    features: DataFrame, model: PipelineModel, keep: Sequence[str] = ()
) -> DataFrame:
    """Adds ``probability`` of the positive class; no shuffle."""
    require_features(
        [c for c in features.columns if c not in keep], model_features(model)
    )
    return (
        model.transform(features)
        .withColumn("probability", vector_to_array("_probability")[1])
        .drop("_features", "_raw", "_probability", "_prediction")
    )


def predict_label(
    features: DataFrame,
    model: PipelineModel,
    threshold: float = 0.5,
    keep: Sequence[str] = (),
) -> DataFrame:
    return predict_proba(features, model, keep).withColumn(
        "predicted_label", predicted_label(F.col("probability"), threshold)
    )


def feature_importance(model: PipelineModel) -> dict[str, float]:
    importances = model.stages[-1].featureImportances
    return {n: float(v) for n, v in zip(model_features(model), importances.toArray())}


def top_importances(importance: dict[str, float], n: int = 5) -> list[tuple[str, float]]:
    return sorted(importance.items(), key=lambda item: -item[1])[:n]
