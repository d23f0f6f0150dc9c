"""Null-safe joins, and running totals that never need one task per key.

A window over ``partitionBy(key)`` puts a whole key into one task. The operators of this package cut
keys into blocks of their ordering column instead: each block is scanned on its own, and what the
earlier blocks contribute is one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def equal_on(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a null key equals a null key, keeping the left key columns."""
    other = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    condition = None
    for c in on:
        term = left[c].eqNullSafe(other[f"_r_{c}"])
        condition = term if condition is None else condition & term
    return left.join(other, condition, "left").drop(*[f"_r_{c}" for c in on])


def running_totals(
    df: DataFrame,
    order: str,
    block: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<c>``, the sum of ``c`` over all rows at or before this one in ``order``, and ``all_<c>``, over all.

    ``block`` must rise with ``order`` (fall with it if ``descending``: it is read in the same
    direction). A block is one task's work; between blocks only their totals are combined.
    """
    way = F.desc if descending else F.asc
    inside = (
        Window.partitionBy(*by, block)
        .orderBy(way(order))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy(way(block))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
    totals = df.groupBy(*by, block).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = totals.select(
        *by,
        block,
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(Window.partitionBy(*by)).alias(f"all_{c}") for c in sums],
    )
    joined = equal_on(local, before, [*by, block])
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{c}") + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"all_{c}" for c in sums],
    )


def with_value_blocks(df: DataFrame, column: str, n_blocks: int = 256) -> DataFrame:
    """Add ``block``, which rises with ``column`` and cuts the rows into about equal parts.

    The cuts are approximate quantiles: one array of fixed size from a scalar subquery.
    """
    points = [i / n_blocks for i in range(1, n_blocks)]
    cuts = df.agg(F.percentile_approx(column, points, 10 * n_blocks)).scalar()
    below = F.filter("_cuts", lambda cut: cut < F.col(column))
    return df.withColumn("_cuts", cuts).withColumn("block", F.size(below)).drop("_cuts")
