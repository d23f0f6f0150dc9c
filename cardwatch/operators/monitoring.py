"""Reports over a log of predictions: one row per decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.functions.display import decision_text, percent_text, short_id
from cardwatch.operators.quantiles import exact_quantiles

# Exported metric names with their type and the statistic they carry.
METRICS = [
    ("fraud_predictions_total", "counter", "total_predictions"),
    ("fraud_detected_total", "counter", "fraud_count"),
    ("fraud_rate_percent", "gauge", "fraud_rate_pct"),
    ("predict_latency_ms_avg", "gauge", "avg_latency_ms"),
]


def prediction_stats(log: DataFrame) -> DataFrame:
    """One row of running figures; all 0 for an empty log."""
    n = F.col("total_predictions")
    rate = F.try_divide(F.col("fraud_count").cast("double"), n) * 100
    return log.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if("is_fraud").alias("fraud_count"),
        F.count_if(~F.col("is_fraud")).alias("legit_count"),
        F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 1).alias("avg_latency_ms"),
    ).withColumn("fraud_rate_pct", F.round(F.coalesce(rate, F.lit(0.0)), 2))


def metric_rows(stats: DataFrame) -> DataFrame:
    """The statistics as rows of metric name, type and value."""
    lines = [
        F.struct(
            F.lit(name).alias("metric"),
            F.lit(kind).alias("type"),
            F.col(source).cast("double").alias("value"),
        )
        for name, kind, source in METRICS
    ]
    return stats.select(F.inline(F.array(*lines)))


def recent_predictions(log: DataFrame, n: int = 50) -> DataFrame:
    """The last n decisions, newest first."""
    return log.orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(n)


def display_rows(log: DataFrame, n: int = 50) -> DataFrame:
    """The last n decisions as shown to an operator."""
    return recent_predictions(log, n).select(
        "transaction_id",
        short_id(F.col("transaction_id")).alias("id_label"),
        percent_text(F.col("fraud_probability")).alias("probability_text"),
        decision_text(F.col("is_fraud")).alias("decision_text"),
        "risk_level",
        F.lower("risk_level").alias("level_class"),
        F.concat_ws(" ", F.col("latency_ms").cast("string"), F.lit("ms")).alias("latency_text"),
    )


def latency_summary(log: DataFrame) -> DataFrame:
    """Latency percentiles, requests per second and failure rate of a request log."""
    points = exact_quantiles(log, "latency_ms", {"p50": 0.50, "p95": 0.95})
    p = points.select(F.struct("p50", "p95")).scalar()
    return log.agg(
        F.count(F.lit(1)).alias("n_requests"),
        (F.max("timestamp") - F.min("timestamp")).alias("elapsed_s"),
        F.avg(F.col("failed").cast("double")).alias("failure_rate"),
    ).select(
        "n_requests",
        p["p50"].alias("p50_ms"),
        p["p95"].alias("p95_ms"),
        F.try_divide(F.col("n_requests").cast("double"), "elapsed_s").alias("requests_per_s"),
        "failure_rate",
    )
