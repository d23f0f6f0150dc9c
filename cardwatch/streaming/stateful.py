"""Operators that keep state per key: exact trailing velocity, running score, result reuse.

Rows of a key are handled in time order within a micro-batch; a row that arrives in a later
batch than newer rows is counted against the history the state holds. One task gets the rows
that a key has in one micro-batch, whose size is bounded at the source, and only the columns it
needs. The state per key is bounded by its time span. Streams carry their event time in ``at``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cardwatch.functions.moments import EPSILON

LATE_SECONDS = 600


def _collect(parts: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(parts), ignore_index=True).sort_values(order, kind="stable")


def trailing_velocity(
    tx: DataFrame, seconds: int = 3600, alias: str = "velocity_1h_calc", late: int = LATE_SECONDS
) -> DataFrame:
    """Per row the number of the client's transactions in the trailing frame, itself included.

    As in the batch operator, only transactions with an id are counted. A row without a time has no frame
    on a stream: it is passed on with a null. The state holds a count per second over one frame and the
    lateness, not the rows.
    """

    def count(
        key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = _collect(parts, ["timestamp", "transaction_id"])
        timed = rows["timestamp"].notna().to_numpy()
        t = rows["timestamp"].to_numpy(float, na_value=np.nan)[timed].astype(np.int64)
        inside = pd.array([pd.NA] * len(rows), dtype="Int64")
        if len(t):
            old_at, old_n = state.get if state.exists else ([], [])
            known = rows["transaction_id"].notna().to_numpy()[timed].astype(np.int64)
            at = np.concatenate([np.asarray(old_at, np.int64), t])
            n = np.concatenate([np.asarray(old_n, np.int64), known])
            at, place = np.unique(at, return_inverse=True)
            total = np.concatenate([[0], np.cumsum(np.bincount(place, weights=n).astype(np.int64))])
            inside[timed] = total[np.searchsorted(at, t, "right")] - total[np.searchsorted(at, t - seconds)]
            keep = at >= at[-1] - seconds - late
            state.update((at[keep].tolist(), np.diff(total)[keep].tolist()))
            _expire(state, int(at[-1]) + seconds + late)
        yield rows[["transaction_id", "timestamp"]].assign(client_id=key[0], **{alias: inside})[
            ["transaction_id", "client_id", "timestamp", alias]
        ]

    narrow = tx.select("client_id", "transaction_id", "timestamp", "at")
    return narrow.groupBy("client_id").applyInPandasWithState(
        count,
        f"transaction_id bigint, client_id bigint, timestamp bigint, {alias} bigint",
        "at array<bigint>, n array<bigint>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def _expire(state: GroupState, second: int) -> None:
    """Drop the state once the watermark has passed the given time."""
    state.setTimeoutTimestamp(max(second * 1000, state.getCurrentWatermarkMs() + 1))


def running_zscore(tx: DataFrame, alias: str = "zscore_running") -> DataFrame:
    """Per row the z-score of the amount against all of the client's amounts so far.

    Nulls are skipped; NaN and infinities count from their row on, as in the batch operator. A score that is NaN
    there is null here, as rows come back through pandas, which has one value for both.
    """

    def score(
        key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = _collect(parts, ["timestamp", "transaction_id"])
        n0, mean0, m20, odd0 = state.get if state.exists else (0, 0.0, 0.0, [0, 0, 0])
        x = rows["amount"].to_numpy(float, na_value=np.nan)
        given = rows["amount_given"].to_numpy(bool)
        finite = np.isfinite(x)
        # Sums of deviations from the mean so far, or from the first value, continue the merged state.
        centre = mean0 if n0 or not finite.any() else float(x[finite][0])
        d = np.where(finite, x - centre, 0.0)
        n = n0 + np.cumsum(finite)
        s1 = n0 * (mean0 - centre) + np.cumsum(d)
        s2 = m20 + n0 * (mean0 - centre) ** 2 + np.cumsum(d * d)
        kinds = (np.isnan(x) & given, x == np.inf, x == -np.inf)
        nan, up, down = (o + np.cumsum(k) for o, k in zip(odd0, kinds))
        odd = nan + up + down
        with np.errstate(all="ignore"):
            mean = centre + s1 / n
            spread = np.sqrt(np.maximum(s2 - s1 * s1 / n, 0.0) / (n - 1))
            mean = np.select(
                [(nan > 0) | ((up > 0) & (down > 0)), up > 0, down > 0], [np.nan, np.inf, -np.inf], mean
            )
            spread = np.where(odd > 0, np.nan, spread)
            score = (x - mean) / (spread + EPSILON)
        out = np.where(given & (n + odd > 1), score, 0.0)
        if len(n):
            last = (int(n[-1]), float(centre + s1[-1] / n[-1]) if n[-1] else 0.0,
                    float(max(s2[-1] - s1[-1] ** 2 / n[-1], 0.0)) if n[-1] else 0.0)
            state.update((*last, [int(nan[-1]), int(up[-1]), int(down[-1])]))
        yield rows[["transaction_id"]].assign(client_id=key[0], **{alias: out})[
            ["transaction_id", "client_id", alias]
        ]

    # Pandas has one value for null and NaN, so the difference travels beside it.
    narrow = tx.select(
        "client_id", "transaction_id", "timestamp", "amount", F.isnotnull("amount").alias("amount_given")
    )
    return narrow.groupBy("client_id").applyInPandasWithState(
        score,
        f"transaction_id bigint, client_id bigint, {alias} double",
        "n bigint, mean double, m2 double, odd array<bigint>",
        "append",
        GroupStateTimeout.NoTimeout,
    )


#: Groups that result reuse deals its keys into. A call of Python costs far more than a row, and keys have few rows each.
BUCKETS = 4096


def reuse_buckets(tx: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``names`` of the rows with a time, their bucket, and which of their keys are null.

    A bucket's rows have the same null keys, and a null id travels beside a filled one, as whole numbers would become
    floating ones beside a null.
    """
    absent = F.concat(*[F.when(F.isnull(k), "1").otherwise("0") for k in keys])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    rows = tx.where(F.col("timestamp").isNotNull())
    given = F.isnotnull("transaction_id")
    if "transaction_id" not in keys and isinstance(tx.schema["transaction_id"].dataType, T.IntegralType):
        rows = rows.withColumns({"_given": given, "transaction_id": F.coalesce("transaction_id", F.lit(0))})
    else:
        rows = rows.withColumn("_given", given)
    return rows.select(bucket.alias("_bucket"), absent.alias("_absent"), *names, "_given", "at")


def reuse_state(tx: DataFrame, keys: list[str]) -> str:
    """The state of a bucket: its keys, a column an array, and the times of their last kept rows."""
    return ", ".join([f"k{i} array<{tx.schema[k].dataType.simpleString()}>" for i, k in enumerate(keys)] + ["last array<bigint>"])


def keep_of_bucket(
    parts: Iterator[pd.DataFrame], state: tuple | None, keys: list[str], names: list[str], lifetime: int, oldest: int
) -> tuple[pd.DataFrame, tuple | None]:
    """The kept rows of a bucket, and its state after them without the times before ``oldest``."""
    last = {}
    if state is not None:
        *columns, times = state
        last = {key: at for key, at in zip(zip(*columns), times) if at >= oldest}
    parts = [part for part in parts if len(part)]
    if not parts:
        return pd.DataFrame(columns=names), _as_state(last, len(keys))
    rows = pd.concat(parts, ignore_index=True)
    rows = rows.assign(_lacks=~rows["_given"].astype(bool)).sort_values(["timestamp", "_lacks", "transaction_id"], kind="stable")
    code = rows.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    first = np.unique(code, return_index=True)[1]
    own = list(zip(*[[None if pd.isna(x) else x for x in rows[k].iloc[first].tolist()] for k in keys]))
    opens = [last[key] + lifetime if key in last else None for key in own]
    kept = []
    for i, (c, at) in enumerate(zip(code.tolist(), rows["timestamp"].to_numpy(np.int64).tolist())):
        if opens[c] is None or at >= opens[c]:
            kept.append(i)
            opens[c] = at + lifetime
    last.update((key, at - lifetime) for key, at in zip(own, opens))
    out = rows.iloc[kept]
    if not out["_given"].all() and pd.api.types.is_integer_dtype(out.get("transaction_id")):
        out = out.assign(transaction_id=out["transaction_id"].astype("Int64").where(out["_given"].astype(bool)))
    return out[names], _as_state(last, len(keys))


def _as_state(last: dict[tuple, int], n_keys: int) -> tuple | None:
    if not last:
        return None
    return (*[[key[i] for key in last] for i in range(n_keys)], list(last.values()))


def reuse_results(
    tx: DataFrame, keys: list[str], lifetime: int = 3600, late: int = LATE_SECONDS
) -> DataFrame:
    """Rows that are scored anew; repeats within the lifetime of the last kept row, and rows without a time, are dropped.

    Keys are dealt into buckets, and one call handles all of a bucket; its state is one time per key that can still repeat.
    """
    columns = [c for c in ("transaction_id", "timestamp") if c not in keys]
    fields = {f.name: f.dataType.simpleString() for f in tx.schema.fields}
    names = [*keys, *columns]

    def first_of(
        key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        oldest = state.getCurrentWatermarkMs() // 1000 - lifetime - late
        kept, after = keep_of_bucket(parts, state.get if state.exists else None, keys, names, lifetime, oldest)
        if after is not None:
            state.update(after)
            _expire(state, max(after[-1]) + lifetime + late)
        elif state.exists:
            state.remove()
        yield kept

    return reuse_buckets(tx, keys, names).groupBy("_bucket", "_absent").applyInPandasWithState(
        first_of,
        ", ".join(f"{c} {fields[c]}" for c in names),
        reuse_state(tx, keys),
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
