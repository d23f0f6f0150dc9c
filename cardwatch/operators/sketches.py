"""Mergeable sketches per key and day: distinct values by HyperLogLog, percentiles by KLL.

A day is sketched once; any range of days is a merge of its sketches, whose size is bounded whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = 86_400
#: Registers (as a power of two): a standard error of about 1.6 % for many values; some hundred values are counted exactly.
LG_K = 12
#: Rank error below about 0.7 % at 99 % confidence.
KLL_K = 400


def day_of(ts: str = "timestamp"):
    return F.floor(F.col(ts) / DAY)


def daily_distinct(df: DataFrame, value: str, key: str = "client_id", ts: str = "timestamp", lg_k: int = LG_K) -> DataFrame:
    """(key, day, sketch): the distinct values of a key and day, told by their text; null values, keys and times are left out."""
    rows = df.where(F.col(value).isNotNull() & F.col(key).isNotNull() & F.col(ts).isNotNull())
    return rows.groupBy(key, day_of(ts).alias("day")).agg(F.hll_sketch_agg(F.col(value).cast("string"), lg_k).alias("sketch"))


def trailing_distinct(daily: DataFrame, days: int, key: str = "client_id") -> DataFrame:
    """(key, day, distinct_values): over a day and the ``days`` - 1 before it, for every day that a key has a sketch of.

    A sketch is handed to the days that look back on it, so a key's days need not be in one task; merges combine
    before the shuffle.
    """
    there = daily.select(F.col(key).alias("__key"), F.col("day").alias("__day"))
    seen = daily.withColumn("day", F.explode(F.sequence("day", F.col("day") + days - 1))).select(key, "day", "sketch")
    merged = seen.groupBy(key, "day").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"))
    return merged.join(there, (F.col(key) == F.col("__key")) & (F.col("day") == F.col("__day")), "left_semi")


def daily_percentiles(df: DataFrame, value: str, ts: str = "timestamp", k: int = KLL_K) -> DataFrame:
    """(day, n, sketch): a percentile sketch of each day's values; null values and times are left out."""
    rows = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
    return rows.groupBy(day_of(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch")
    )


def percentiles(daily: DataFrame, points: Mapping[str, float], *keys: str) -> DataFrame:
    """(keys, n, one column a point) of the merged sketches; without keys one row over all days, of nulls if there is none."""
    merged = daily.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(
        *keys, "n", *[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(name) for name, p in points.items()]
    )


def rank_errors(df: DataFrame, value: str, found: DataFrame, points: Mapping[str, float], ts: str = "timestamp") -> DataFrame:
    """(day, n, one error a point): how far the share of values up to an estimate is from the wanted one.

    An estimate that many rows equal has a range of ranks; the error is the distance to that range.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(day_of(ts).alias("__day"), F.col(value).alias("__v"))
    joined = rows.join(found, F.col("__day") == F.col("day"))
    return joined.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.greatest(
                F.lit(0.0),
                F.avg((F.col("__v") < F.col(name)).cast("double")) - p,
                p - F.avg((F.col("__v") <= F.col(name)).cast("double")),
            ).alias(name)
            for name, p in points.items()
        ],
    )
