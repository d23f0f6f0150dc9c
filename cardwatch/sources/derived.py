"""Input tables of single operators, derived from the transactions by expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = 86_400

# A merchant dimension that knows two of the five categories.
MERCHANT_ROWS = [("purchase", "alimentation", 0.02), ("click", "high-tech", 0.08)]


def requests(tx: DataFrame) -> DataFrame:
    """Scoring requests, some of them with values out of range, absent or zero."""
    n, k = F.col("transaction_id"), F.col("merchant_id")
    amount = (
        F.when(n % 11 == 0, -F.col("amount"))
        .when(n % 13 == 0, 0.0)
        .when(n % 17 == 0, 60000.0)
        .otherwise(F.col("amount"))
    )
    return tx.select(
        n.cast("string").alias("transaction_id"),
        amount.alias("amount"),
        (k % 53).cast("double").alias("velocity_1h"),
        ((k % 22).cast("double") / 20.0).alias("night_tx_ratio"),
        F.when(n % 97 != 0, F.col("V14")).alias("V14"),
        "V17",
        F.when(n % 3 != 0, F.col("V14") / 2.0).alias("zscore_amount"),
        F.when(n % 5 == 1, 0.0).when(n % 5 > 1, F.col("V17") / 2.0).alias("zscore_amount_calc"),
        F.when(n % 5 == 1, 0.0)
        .when(n % 5 > 1, (k % 52).cast("double"))
        .alias("velocity_1h_calc"),
        F.when(n % 7 == 1, 0.0).when(n % 7 > 1, (n % 7).cast("double") / 5.0).alias("risk_score"),
        F.when(n % 2 == 0, F.col("V14") / 10.0).alias("V4"),
        F.when(n % 4 == 0, F.col("V17") / 10.0).alias("V11"),
        F.when(n % 8 == 0, F.lit(0.25)).alias("V12"),
        F.when(n % 9 != 0, F.col("merchant_category")).alias("merchant_category"),
        "timestamp",
    )


def raw_feed(tx: DataFrame) -> DataFrame:
    """Bronze rows: every transaction delivered twice, countries untidy, some components absent."""
    n = F.col("transaction_id")
    raw = tx.withColumns(
        {
            "country": F.when(n % 2 == 0, F.concat(F.lit(" "), F.lower("country"))).otherwise(
                F.col("country")
            ),
            "V14": F.when(n % 97 != 0, F.col("V14")),
        }
    )
    again = F.explode(F.array(F.lit(0), F.lit(60)))
    return (
        raw.withColumn("_later", again)
        .withColumn("timestamp", F.col("timestamp") + F.col("_later"))
        .drop("_later")
    )


def feedback(tx: DataFrame) -> DataFrame:
    """Operators review every transaction of the error category, in the morning twice."""
    reviewed = tx.where(F.col("merchant_category") == "error")
    both, one = (F.array(*map(F.lit, n)).cast("array<bigint>") for n in ((1, 2), (1,)))
    versions = F.when(F.col("hour") < 12, both).otherwise(one)
    return reviewed.select(
        "transaction_id", "is_fraud", F.explode(versions).alias("version")
    ).select(
        "transaction_id",
        F.when(F.col("version") == 1, F.col("is_fraud") == 0)
        .otherwise(F.col("is_fraud") == 1)
        .alias("true_label"),
        F.lit("OPS-001").alias("operator_id"),
        "version",
    )


def prediction_log(tx: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One decision per transaction, with the latency it took."""
    p = 1.0 / (1.0 + F.exp(F.col("V17") * 3.0))
    return tx.select(
        "transaction_id",
        "timestamp",
        F.round(p, 4).alias("fraud_probability"),
        (p >= threshold).alias("is_fraud"),
        (5 + F.col("transaction_id") % 90).cast("double").alias("latency_ms"),
        (F.col("merchant_category") == "error").alias("failed"),
        F.col("is_fraud").alias("label"),
    )


def feature_snapshots(tx: DataFrame) -> DataFrame:
    """Mean amount per client and day, valid from the next midnight."""
    day = F.floor(F.col("timestamp") / DAY)
    return tx.groupBy("client_id", day.alias("day")).agg(
        F.avg("amount").alias("avg_amount_day"), F.count(F.lit(1)).alias("tx_count_day")
    ).select(
        "client_id",
        ((F.col("day") + 1) * DAY).alias("valid_from"),
        "avg_amount_day",
        "tx_count_day",
    )
