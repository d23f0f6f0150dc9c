"""Three classifiers trained and compared on the cluster.

No row leaves the executors: the driver sees fitted models, one row of counts and the metrics.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators import evaluation, profiles, sampling, scoring

LABEL, WEIGHT, POSITIVE_WEIGHT = "is_fraud", "class_weight", "positive_weight"


def available_features(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def training_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features without nulls, label and the split, which is exact in every class."""
    filled = df.select("transaction_id", LABEL, *features).na.fill(0, subset=list(features))
    return sampling.exact_split(filled, label=LABEL)


def weighted(train: DataFrame) -> DataFrame:
    """Training rows with both class weights, which come from these rows alone."""
    return profiles.with_class_weight(
        profiles.with_class_weight(train, alias=WEIGHT), alias=POSITIVE_WEIGHT, balanced=False
    )


@dataclass(frozen=True)
class Candidate:
    name: str
    estimator: Estimator
    params: Mapping[str, object]


def candidates(n_train: int, trees: int = 100, seed: int = 42) -> list[Candidate]:
    """The compared models, in the order in which ties are resolved."""
    common = dict(labelCol=LABEL, featuresCol="features", seed=seed)
    linear_c, max_iter = 0.1, 300
    boosted = dict(maxDepth=4, maxIter=trees, stepSize=0.1, subsamplingRate=0.8)
    forest = dict(numTrees=trees, maxDepth=6, minInstancesPerNode=5)
    return [
        Candidate(
            "GBT",
            GBTClassifier(
                weightCol=POSITIVE_WEIGHT, featureSubsetStrategy="0.8", **boosted, **common
            ),
            boosted,
        ),
        Candidate(
            "RF",
            RandomForestClassifier(
                weightCol=WEIGHT, featureSubsetStrategy="sqrt", **forest, **common
            ),
            forest,
        ),
        Candidate(
            "LR",
            LogisticRegression(
                labelCol=LABEL,
                featuresCol="features",
                weightCol=WEIGHT,
                # The balanced weights sum to the number of training rows.
                regParam=1.0 / (linear_c * max(n_train, 1)),
                elasticNetParam=0.0,
                # The features are standardised before, so coefficients are on one scale.
                standardization=False,
                maxIter=max_iter,
            ),
            {"C": linear_c, "maxIter": max_iter},
        ),
    ]


def fit(candidate: Candidate, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assembler, a scaler for the linear model, estimator."""
    linear = isinstance(candidate.estimator, LogisticRegression)
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw" if linear else "features")
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    stages = [assembler, *[scaler] * linear, candidate.estimator]
    return Pipeline(stages=stages).fit(train)


def scored(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Label and fraud probability."""
    return scoring.fitted_model(model)(df).select(
        "transaction_id", LABEL, F.col("probability").alias("score")
    )


def test_metrics(scores: DataFrame) -> DataFrame:
    """One row: AUC, and F1, precision and recall of the decision at 0.5, to 4 digits."""
    area = evaluation.auc_roc(scores, digits=None).scalar()
    at_half = evaluation.metrics_of(evaluation.confusion_matrix(scores, 0.5))
    return at_half.select(
        F.round(area, 4).alias("auc_roc"),
        *[F.round(c, 4).alias(c) for c in ("f1", "precision", "recall")],
    )


@dataclass
class Comparison:
    """Fitted models by name, and one run per model."""

    models: dict[str, PipelineModel]
    runs: DataFrame


def compare_models(
    df: DataFrame,
    features: Sequence[str] = schemas.MODEL_FEATURES,
    only: Sequence[str] = ("GBT", "RF", "LR"),
    trees: int = 100,
    experiment: str = "p1-model-comparison",
) -> Comparison:
    """Fit the candidates on the training part of ``df`` and measure them on the rest."""
    spark = df.sparkSession
    features = available_features(df, features)
    table = training_table(df, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = weighted(table.where("split = 'train'"))
        test = table.where("split = 'test'")
        sizes = table.agg(
            F.count_if(F.col("split") == "train").alias("train"),
            F.count_if(F.col("split") == "test").alias("test"),
            F.avg(LABEL).alias("rate"),
        ).first()
        models, rows = {}, []
        for seq, candidate in enumerate(candidates(sizes["train"], trees)):
            if candidate.name not in only:
                continue
            model = fit(candidate, train, features)
            metrics = test_metrics(scored(model, test)).first().asDict()
            models[candidate.name] = model
            params = {
                "model_type": candidate.name,
                "train_size": sizes["train"],
                "test_size": sizes["test"],
                "n_features": len(features),
                "features": ", ".join(features),
                "fraud_rate": round(sizes["rate"], 3),
                **candidate.params,
            }
            rows.append(
                (
                    uuid.uuid4().hex,
                    experiment,
                    candidate.name,
                    seq,
                    dt.datetime.now(),
                    {k: str(v) for k, v in params.items()},
                    {k: float(v) for k, v in metrics.items() if v is not None},
                )
            )
        return Comparison(models, spark.createDataFrame(rows, schemas.RUNS))
    finally:
        table.unpersist()


def best_model(runs: DataFrame, metric: str = "auc_roc") -> DataFrame:
    """The run of the highest metric; of equal ones the first."""
    return runs.orderBy(F.col("metrics")[metric].desc_nulls_last(), "seq").limit(1)


@dataclass
class Chosen:
    """The best of the compared models, calibrated on its test scores."""

    name: str
    model: PipelineModel
    threshold: float
    scores: DataFrame
    runs: DataFrame


def choose(
    df: DataFrame,
    features: Sequence[str] = schemas.MODEL_FEATURES,
    trees: int = 100,
    recall: float = 0.90,
    experiment: str = "p1-model-comparison",
) -> Chosen:
    """Compare, pick the best by AUC, calibrate its threshold on its test scores, and log that as one more run.

    The threshold is the highest test score that reaches the recall; it is rounded down to three digits, as it
    is saved, so that the saved one reaches the recall too.
    """
    spark = df.sparkSession
    compared = compare_models(df, features, trees=trees, experiment=experiment)
    best = best_model(compared.runs).first()
    model = compared.models[best["run_name"]]
    table = training_table(df, available_features(df, features))
    scores = scored(model, table.where("split = 'test'"))
    exact = evaluation.calibrated_threshold(scores, recall=recall).first()["threshold"]
    threshold = 0.5 if exact is None else math.floor(exact * 1000) / 1000
    summary = evaluation.metrics_of(evaluation.confusion_matrix(scores, threshold)).first()
    run = (
        uuid.uuid4().hex, experiment, f"best-{best['run_name']}", best["seq"] + 100, dt.datetime.now(),
        {**best["params"], "threshold": str(threshold)},
        {"auc_roc": best["metrics"]["auc_roc"], **{k: float(summary[k]) for k in ("f1", "precision", "recall")}},
    )
    runs = compared.runs.unionByName(spark.createDataFrame([run], schemas.RUNS))
    return Chosen(best["run_name"], model, threshold, scores, runs)


def latest_run(runs: DataFrame, experiment: str | None = None) -> DataFrame:
    """The identifier of the run that started last."""
    rows = runs if experiment is None else runs.where(F.col("experiment") == experiment)
    return rows.agg(F.max_by("run_id", F.struct("start_time", "seq")).alias("run_id"))


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Importance per feature, or the size of its coefficient on standardised features, highest first."""
    assembler, predictor = model.stages[0], model.stages[-1]
    if hasattr(predictor, "featureImportances"):
        values = predictor.featureImportances.toArray()
    else:
        values = np.abs(predictor.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(assembler.getInputCols(), values, strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
