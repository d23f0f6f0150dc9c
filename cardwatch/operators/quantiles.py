"""Quantiles: exact by a distributed value histogram, approximate by a sketch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.skew import running_totals, with_value_blocks


def exact_quantiles(df: DataFrame, column: str, points: Mapping[str, float]) -> DataFrame:
    """One row with a column per point, interpolated linearly between neighbouring ranks.

    Equal values are counted before they move, and the running count is blocked, so neither
    a frequent value nor many different values end up in one task.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(with_value_blocks(counts, "value"), "value", "block", ["n"])

    def value_at(rank):
        return F.min(F.when(F.col("cum_n") > rank, F.col("value")))

    parts = []
    for name, p in points.items():
        place = F.col("all_n").cast("double") * p - p
        parts += [
            value_at(F.floor(place)).alias(f"low_{name}"),
            value_at(F.ceil(place)).alias(f"high_{name}"),
            F.max(place - F.floor(place)).alias(f"part_{name}"),
        ]
    ends = ranked.agg(*parts)
    return ends.select(
        *[
            (
                F.col(f"low_{name}")
                + (F.col(f"high_{name}") - F.col(f"low_{name}")) * F.col(f"part_{name}")
            ).alias(name)
            for name in points
        ]
    )


def approximate_quantiles(
    df: DataFrame, column: str, points: Mapping[str, float], relative_error: float = 0.01
) -> DataFrame:
    """One row with a column per point; ranks are off by at most ``relative_error``."""
    accuracy = max(1, round(1 / relative_error))
    return df.agg(
        *[F.percentile_approx(column, p, accuracy).alias(name) for name, p in points.items()]
    )
