"""Saved models and the table of their versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas

PRODUCTION, ARCHIVED = "Production", "Archived"


def no_versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.MODEL_VERSIONS)


def promote(versions: DataFrame, name: str, run_id: str, path: str) -> DataFrame:
    """The version table after ``run_id`` became the model in production.

    The version before is archived; a table is small, one row per version ever promoted.
    """
    spark = versions.sparkSession
    mine = F.col("name") == name
    stage = F.when(mine & (F.col("stage") == PRODUCTION), ARCHIVED).otherwise(F.col("stage"))
    last = versions.where(mine).agg(F.coalesce(F.max("version"), F.lit(0))).scalar()
    new = spark.range(1).select(
        F.lit(name).alias("name"),
        (last + 1).cast("int").alias("version"),
        F.lit(PRODUCTION).alias("stage"),
        F.lit(run_id).alias("run_id"),
        F.lit(path).alias("path"),
    )
    return versions.withColumn("stage", stage).unionByName(new)


def promote_if_better(
    versions: DataFrame, runs: DataFrame, name: str, run_id: str, path: str, metric: str = "auc_roc"
) -> DataFrame:
    """Promote ``run_id`` unless the run in production has the metric as high or higher."""
    current = in_production(versions, name).select("run_id").first()
    wanted = [run_id, current["run_id"]] if current else [run_id]
    value = {
        r["run_id"]: r["metrics"].get(metric)
        for r in runs.where(F.col("run_id").isin(wanted)).select("run_id", "metrics").collect()
    }
    old = value.get(current["run_id"]) if current else None
    new = value.get(run_id)
    if new is None or (old is not None and old >= new):
        return versions
    return promote(versions, name, run_id, path)


def in_production(versions: DataFrame, name: str) -> DataFrame:
    return versions.where((F.col("name") == name) & (F.col("stage") == PRODUCTION))


def save_model(model: PipelineModel, path: str, features: Sequence[str], threshold: float) -> None:
    """The pipeline, and beside it one row with the feature order and the rounded threshold."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame(
        [(list(features), round(threshold, 3))], "features array<string>, threshold double"
    )
    meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], float]:
    meta = spark.read.parquet(f"{path}/metadata").first()
    return PipelineModel.load(f"{path}/model"), meta["features"], meta["threshold"]
