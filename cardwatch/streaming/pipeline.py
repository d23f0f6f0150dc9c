"""Scoring on a stream, running figures, feature upserts and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators import monitoring, scoring
from cardwatch.session import scratch_path


def score_stream(
    requests: DataFrame, model: scoring.Model, threshold: float, model_version: str
) -> DataFrame:
    """Decisions for a stream of requests: the batch operator has no state, so it serves both."""
    return scoring.score_batch(requests, model, threshold, model_version)


def running_stats(decisions: DataFrame) -> DataFrame:
    """Running figures over all decisions so far; one row, for complete output mode."""
    return monitoring.prediction_stats(decisions)


def upsert_features(tx: DataFrame, name: str = "features") -> str:
    """Write, per micro-batch, the newest features of the clients it touches.

    Batches are folders of an append-only table; one that is repeated overwrites itself.
    """
    spark = tx.sparkSession
    out = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = batch.groupBy("client_id").agg(
            F.max(F.struct("timestamp", "transaction_id", "amount")).alias("last"),
            F.count(F.lit(1)).alias("n_batch"),
        )
        newest.select(
            "client_id",
            F.col("last.timestamp").alias("updated_at"),
            F.col("last.amount").alias("last_amount"),
            "n_batch",
        ).write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    query = (
        tx.writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{out}/data"


def current_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per client: the newest upsert and the number of transactions seen."""
    return spark.read.parquet(path).groupBy("client_id").agg(
        F.max("updated_at").alias("updated_at"),
        F.max_by("last_amount", F.struct("updated_at", "batch_id")).alias("last_amount"),
        F.sum("n_batch").alias("n_seen"),
    )


def lookup_features(tx: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of a stream or table with the current features of its clients."""
    return tx.join(features, "client_id", "left")
