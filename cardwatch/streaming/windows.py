"""Event-time windows; every function takes a batch table or a stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.gold import is_night


def _bounds(window: Column | str = "window") -> list[Column]:
    w = F.col(window) if isinstance(window, str) else window
    return [
        F.unix_seconds(w["start"]).alias("window_start"),
        F.unix_seconds(w["end"]).alias("window_end"),
    ]


def sliding_velocity(
    tx: DataFrame, length: str = "1 hour", slide: str = "10 minutes"
) -> DataFrame:
    """Transactions per client and sliding window."""
    return (
        tx.groupBy("client_id", F.window("at", length, slide))
        .agg(F.count("transaction_id").alias("velocity"))
        .select("client_id", *_bounds(), "velocity")
    )


def tumbling_merchants(
    tx: DataFrame, length: str = "7 days", closed_only: bool = False
) -> DataFrame:
    """Distinct merchants per client and tumbling window.

    The set of merchants is combined before the shuffle and is the state on a stream, so that open
    windows can be given out in update mode. With ``closed_only`` there are two stages, which spread a
    busy client over the tasks by merchant; on a stream these give a window out once the watermark has
    passed it.
    """
    if not closed_only:
        merchants = F.size(F.collect_set("merchant_id")).cast("long")
        return (
            tx.where(F.col("merchant_id").isNotNull())
            .groupBy("client_id", F.window("at", length))
            .agg(merchants.alias("distinct_merchants"))
            .select("client_id", *_bounds(), "distinct_merchants")
        )
    return (
        tx.where(F.col("merchant_id").isNotNull())
        .select("client_id", "merchant_id", F.window("at", length).alias("window"))
        .dropDuplicates(["client_id", "merchant_id", "window"])
        .groupBy("client_id", "window")
        .agg(F.count(F.lit(1)).alias("distinct_merchants"))
        .select("client_id", *_bounds(), "distinct_merchants")
    )


def tumbling_night_ratio(tx: DataFrame, length: str = "30 days") -> DataFrame:
    """Share of night transactions per client and tumbling window."""
    return (
        tx.groupBy("client_id", F.window("at", length))
        .agg(F.avg(is_night(F.col("hour")).cast("double")).alias("night_tx_ratio"))
        .select("client_id", *_bounds(), "night_tx_ratio")
    )
