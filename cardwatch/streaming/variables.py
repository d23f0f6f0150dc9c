"""The keyed operators on state variables and timers (``transformWithState``).

They give the rows of ``streaming.stateful``, but a key's state is not one record that is read and written whole: the
velocity holds one map entry a second, of which a batch writes those it touches, and timers delete what the watermark
has passed. The state lies in RocksDB, off the heap, so the session needs that provider (``with_rocksdb``). Rows come in
Arrow batches; of a batch's rows only times, ids and one value are held at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cardwatch.functions.moments import EPSILON
from cardwatch.streaming.stateful import LATE_SECONDS

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB; the session's own provider comes back afterwards."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _in_order(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(parts), ignore_index=True).sort_values(["timestamp", "transaction_id"], kind="stable")


class Velocity(StatefulProcessor):
    """Counts per second in a map; a timer per batch drops the seconds that no frame can reach any more."""

    def __init__(self, seconds: int, alias: str, late: int) -> None:
        self.seconds, self.alias, self.late = seconds, alias, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "at bigint", "n bigint")

    def _known(self) -> dict[int, int]:
        return {at: n for (at,), (n,) in self.counts.iterator()} if self.counts.exists() else {}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows)
        timed = batch["timestamp"].notna().to_numpy()
        t = batch["timestamp"].to_numpy(float, na_value=np.nan)[timed].astype(np.int64)
        inside = pd.array([pd.NA] * len(batch), dtype="Int64")
        if len(t):
            counted = batch["transaction_id"].notna().to_numpy()[timed]
            seconds, n = np.unique(t[counted], return_counts=True)
            known = self._known()
            for at, more in zip(seconds.tolist(), n.tolist()):
                known[at] = known.get(at, 0) + more
                self.counts.updateValue((at,), (known[at],))
            at = np.array(sorted(known), dtype=np.int64)
            total = np.concatenate([[0], np.cumsum([known[a] for a in at.tolist()], dtype=np.int64)])
            inside[timed] = total[np.searchsorted(at, t, "right")] - total[np.searchsorted(at, t - self.seconds)]
            expiry = (int(t[-1]) + self.seconds + self.late) * 1000
            self.handle.registerTimer(max(expiry, timerValues.getCurrentWatermarkInMs() + 1))
        yield batch[["transaction_id", "timestamp"]].assign(client_id=key[0], **{self.alias: inside})[
            ["transaction_id", "client_id", "timestamp", self.alias]
        ]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # Rows behind the watermark are dropped before they get here, and those before it reach back one frame.
        oldest = timerValues.getCurrentWatermarkInMs() // 1000 - self.seconds - self.late
        for at in [a for a in self._known() if a < oldest]:
            self.counts.removeKey((at,))
        return iter(())

    def close(self) -> None:
        pass


def trailing_velocity(
    tx: DataFrame, seconds: int = 3600, alias: str = "velocity_1h_calc", late: int = LATE_SECONDS
) -> DataFrame:
    """Per row the number of the client's transactions in the trailing frame, itself included.

    Only transactions with an id are counted; a row without a time is passed on with a null.
    """
    narrow = tx.select("client_id", "transaction_id", "timestamp", "at")
    return narrow.groupBy("client_id").transformWithStateInPandas(
        Velocity(seconds, alias, late),
        f"transaction_id bigint, client_id bigint, timestamp bigint, {alias} bigint",
        "append",
        "eventTime",
    )


class RunningScore(StatefulProcessor):
    """Number, mean and squared deviations of the values so far, and numbers of the unusual ones."""

    def __init__(self, alias: str) -> None:
        self.alias = alias

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", "n bigint, mean double, m2 double")
        self.odd = handle.getValueState("odd", "nan bigint, up bigint, down bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows)
        n0, mean0, m20 = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0)
        odd0 = self.odd.get() if self.odd.exists() else (0, 0, 0)
        x = batch["amount"].to_numpy(float, na_value=np.nan)
        given = batch["amount_given"].to_numpy(bool)
        finite = np.isfinite(x)
        # Deviations from the mean so far, or from the first value, continue the state without cancellation.
        centre = mean0 if n0 or not finite.any() else float(x[finite][0])
        away = np.where(finite, x - centre, 0.0)
        n = n0 + np.cumsum(finite)
        s1 = n0 * (mean0 - centre) + np.cumsum(away)
        s2 = m20 + n0 * (mean0 - centre) ** 2 + np.cumsum(away * away)
        kinds = (np.isnan(x) & given, x == np.inf, x == -np.inf)
        seen = [before + np.cumsum(kind) for before, kind in zip(odd0, kinds)]
        spoilt = sum(seen)
        with np.errstate(all="ignore"):
            mean, m2 = centre + s1 / n, np.maximum(s2 - s1 * s1 / n, 0.0)
            score = (x - mean) / (np.sqrt(m2 / (n - 1)) + EPSILON)
        # Any score beside a NaN or an infinity is undefined, as the deviation is.
        score = np.where(spoilt > 0, np.nan, score)
        out = np.where(given & (n + spoilt > 1), score, 0.0)
        if n[-1]:
            self.moments.update((int(n[-1]), float(mean[-1]), float(m2[-1])))
        if spoilt[-1]:
            self.odd.update(tuple(int(c[-1]) for c in seen))
        yield batch[["transaction_id"]].assign(client_id=key[0], **{self.alias: out})[
            ["transaction_id", "client_id", self.alias]
        ]

    def close(self) -> None:
        pass


def running_zscore(tx: DataFrame, alias: str = "zscore_running") -> DataFrame:
    """Per row the z-score of the amount against all of the client's amounts so far.

    Nulls are skipped; an undefined score, beside NaN or infinities, is null.
    """
    # Pandas has one value for null and NaN, so the difference travels beside it.
    narrow = tx.select(
        "client_id", "transaction_id", "timestamp", "amount", F.isnotnull("amount").alias("amount_given")
    )
    return narrow.groupBy("client_id").transformWithStateInPandas(
        RunningScore(alias), f"transaction_id bigint, client_id bigint, {alias} double", "append", "none"
    )


class Reuse(StatefulProcessor):
    """The time of the last kept row; a timer drops it once no row can repeat it."""

    def __init__(self, names: list[str], lifetime: int, late: int) -> None:
        self.names, self.lifetime, self.late = names, lifetime, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch = _in_order(part[part["timestamp"].notna()] for part in rows)
        t = batch["timestamp"].to_numpy(np.int64)
        at, kept = 0, []
        if self.last.exists():
            at = int(np.searchsorted(t, self.last.get()[0] + self.lifetime))
        while at < len(t):
            kept.append(at)
            at = int(np.searchsorted(t, t[at] + self.lifetime))
        if kept:
            last = int(t[kept[-1]])
            self.last.update((last,))
            expiry = (last + self.lifetime + self.late) * 1000
            self.handle.registerTimer(max(expiry, timerValues.getCurrentWatermarkInMs() + 1))
        yield batch.iloc[kept][self.names]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        # A later row may have been kept since the timer was set; that row has a timer of its own.
        over = (self.last.get()[0] + self.lifetime + self.late) * 1000 if self.last.exists() else None
        if over is not None and over <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def reuse_results(tx: DataFrame, keys: list[str], lifetime: int = 3600, late: int = LATE_SECONDS) -> DataFrame:
    """Rows that are scored anew; repeats within the lifetime of the last kept row, and rows without a time, are dropped."""
    columns = [c for c in ("transaction_id", "timestamp") if c not in keys]
    fields = {f.name: f.dataType.simpleString() for f in tx.schema.fields}
    names = [*keys, *columns]
    return tx.select(*names, "at").groupBy(*keys).transformWithStateInPandas(
        Reuse(names, lifetime, late), ", ".join(f"{c} {fields[c]}" for c in names), "append", "eventTime"
    )
