"""Scoring of request tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.functions.display import risk_level
from cardwatch.operators import quality

#: Adds a double column ``probability`` to a table of resolved requests.
Model = Callable[[DataFrame], DataFrame]


def linear_model(weights: Mapping[str, float], intercept: float) -> Model:
    """Logistic model with given weights, kept inside generated code."""

    def apply(df: DataFrame) -> DataFrame:
        z: Column = F.lit(intercept)
        for name, weight in weights.items():
            z = z + F.lit(weight) * F.col(name).cast("double")
        return df.withColumn("probability", 1.0 / (1.0 + F.exp(-z)))

    return apply


def fitted_model(model: PipelineModel) -> Model:
    """A fitted pipeline whose last stage writes a ``probability`` vector."""

    def apply(df: DataFrame) -> DataFrame:
        scored = model.transform(df)
        extra = [c for c in scored.columns if c not in df.columns and c != "probability"]
        return scored.drop(*extra).withColumn("probability", vector_to_array("probability")[1])

    return apply


def feature_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the features the table lacks as 0.0."""
    missing = {c: F.lit(0.0) for c in features if c not in df.columns}
    return df.withColumns(missing) if missing else df


def decide(df: DataFrame, threshold: float, model_version: str) -> DataFrame:
    """Turn ``probability`` into the decision columns."""
    p = F.col("probability")
    return df.withColumns(
        {
            "is_fraud": p >= threshold,
            "risk_level": risk_level(p),
            "fraud_probability": F.round(p, 4),
            "model_version": F.lit(model_version),
        }
    ).drop("probability")


def score_batch(
    requests: DataFrame,
    model: Model,
    threshold: float,
    model_version: str,
    features: Sequence[str] = schemas.MODEL_FEATURES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decisions for the valid requests; ``quality.rejected`` gives the others."""
    valid = requests.where(quality.is_valid(requests.columns))
    resolved = quality.resolve_features(quality.apply_defaults(valid))
    scored = model(feature_frame(resolved, features))
    return decide(scored, threshold, model_version).select(
        "transaction_id",
        *keep,
        "is_fraud",
        "fraud_probability",
        "risk_level",
        "model_version",
    )
