"""Result reuse for a limited time, as a batch operator.

Per key the first row counts; rows less than the lifetime after the last *kept* row repeat it
and are dropped. A row exactly one lifetime later is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from cardwatch.operators.skew import equal_on

LIFETIME = 3600
SEGMENT = 86_400

_TABLE = "array<struct<start: bigint, reopen: bigint>>"


def _advance(times: np.ndarray, place: np.ndarray, lifetime: int) -> np.ndarray:
    """From each place, the place of the next kept row; a place past the end stays there."""
    inside = place < len(times)
    following = place.copy()
    following[inside] = np.searchsorted(times, times[place[inside]] + lifetime)
    return following


def _table_udf(lifetime: int, segment: int):
    """Per segment: for every row that can be its first kept one, when reuse ends afterwards."""

    @pandas_udf(_TABLE)
    def table(times: pd.Series, fresh: pd.Series) -> pd.Series:
        out = []
        for row, is_fresh in zip(times, fresh, strict=True):
            t = np.asarray(row, dtype=np.int64)
            begin = t[0] // segment * segment
            # Reuse from before ends within one lifetime, so later rows cannot come first.
            n = 1 if is_fresh else min(len(t), int(np.searchsorted(t, begin + lifetime)) + 1)
            place = np.arange(n)
            last = place
            while (place < len(t)).any():
                last = np.where(place < len(t), place, last)
                place = _advance(t, place, lifetime)
            ends = t[last] + lifetime
            out.append([{"start": int(a), "reopen": int(b)} for a, b in zip(t[:n], ends)])
        return pd.Series(out)

    return table


def _kept_udf(lifetime: int):
    """Per segment: the kept times, from the moment on at which reuse has ended."""

    @pandas_udf("array<bigint>")
    def kept(times: pd.Series, opens: pd.Series) -> pd.Series:
        out = []
        for row, start in zip(times, opens, strict=True):
            t = np.asarray(row, dtype=np.int64)
            i, chosen = int(np.searchsorted(t, start)), []
            while i < len(t):
                chosen.append(int(t[i]))
                i = int(np.searchsorted(t, t[i] + lifetime))
            out.append(chosen)
        return pd.Series(out)

    return kept


def _with_open(chained: DataFrame, keys: list[str], lifetime: int, segment: int) -> DataFrame:
    """Add ``_open``: when reuse of rows from before the segment ends."""
    step = F.struct(
        "_segment", _table_udf(lifetime, segment)("_times", "_fresh").alias("table")
    ).alias("step")
    opens_type = "array<struct<_segment: bigint, _open: bigint>>"
    start = F.struct(
        F.lit(-(2**62)).cast("long").alias("open"), F.array().cast(opens_type).alias("opens")
    )

    def advance(state: Column, x: Column) -> Column:
        line = F.try_element_at(F.filter(x["table"], lambda e: e["start"] >= state["open"]), F.lit(1))
        here = F.struct(x["_segment"].alias("_segment"), state["open"].alias("_open"))
        return F.struct(
            F.coalesce(line["reopen"], state["open"]).alias("open"),
            F.array_append(state["opens"], here).alias("opens"),
        )

    runs = (
        chained.select(*keys, "_run", step)
        .groupBy(*keys, "_run")
        .agg(F.sort_array(F.collect_list("step")).alias("steps"))
    )
    opens = runs.select(*keys, F.inline(F.aggregate("steps", start, advance)["opens"]))
    return equal_on(chained, opens, [*keys, "_segment"])


def ttl_dedup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    tie: str = "transaction_id",
    lifetime: int = LIFETIME,
    segment: int = SEGMENT,
) -> DataFrame:
    """The rows of ``df`` that are kept; ``ts`` in whole seconds, (``ts``, ``tie``) unique.

    What is kept depends on the previous kept row, which would tie a whole key to one task.
    Instead rows collapse to the first per key and second, and time is cut into segments. A
    segment that can depend on the one before is summarised by a table from its first kept
    row to the moment at which reuse ends after it: at most ``lifetime + 1`` lines, however
    many rows the segment has. Walking these tables gives every segment its start, and the
    segments are then resolved side by side.
    """
    if segment < lifetime:
        raise ValueError("a segment must be at least one lifetime long")
    keys = list(keys)
    first = df.groupBy(*keys, ts).agg(F.min(tie).alias(tie))
    segments = first.groupBy(*keys, F.floor(F.col(ts) / segment).alias("_segment")).agg(
        F.sort_array(F.collect_list(ts)).alias("_times")
    )
    along = Window.partitionBy(*keys).orderBy("_segment")
    gap = F.element_at("_times", 1) - F.lag(F.element_at("_times", -1)).over(along)
    marked = segments.withColumn("_fresh", F.coalesce(gap >= lifetime, F.lit(True)))
    runs = marked.select(
        "*",
        F.count_if("_fresh").over(along).alias("_run"),
        (
            F.col("_fresh") & F.coalesce(F.lead("_fresh").over(along), F.lit(True))
        ).alias("_whole"),
    )
    one = F.size("_times") == 1
    # Most keys have one row, or rows far apart: nothing to look up for them.
    singles = runs.where(F.col("_whole") & one).select(
        *keys, F.element_at("_times", 1).alias(ts)
    )
    free = runs.where(F.col("_whole") & ~one).select(
        *keys, "_times", F.element_at("_times", 1).alias("_open")
    )
    chained = _with_open(runs.where(~F.col("_whole")), keys, lifetime, segment)
    kept = (
        free.unionByName(chained.select(*keys, "_times", "_open"))
        .select(*keys, F.explode(_kept_udf(lifetime)("_times", "_open")).alias(ts))
        .unionByName(singles)
        .withColumn("_kept", F.lit(True))
    )
    chosen = equal_on(first, kept, [*keys, ts]).where("_kept")
    return equal_on(df, chosen, [*keys, ts, tie]).where("_kept").select(*df.columns)
