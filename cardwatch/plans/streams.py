"""Queries that run a stream over the event file to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators import joins, scoring
from cardwatch.plans.common import (
    LINEAR_INTERCEPT,
    LINEAR_THRESHOLD,
    LINEAR_WEIGHTS,
    MODEL_VERSION,
    Query,
    rounded,
)
from cardwatch.session import scratch_path
from cardwatch.sources import derived
from cardwatch.sources.tables import as_transactions, epoch_seconds, read_table
from cardwatch.streaming import io, late, pipeline, stateful, store, variables, windows

WINDOW = ["client_id", "window_start", "window_end"]


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Braces make it a pattern, so a single file serves as well as a folder of files.
    return io.transaction_stream(spark, f"{sf_dir}/{{events.parquet}}")


def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = windows.sliding_velocity(_stream(spark, sf_dir))
    return io.latest_updates(spark, io.run_updates(counted, "velocity"), WINDOW)


def stream_trailing_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stateful.trailing_velocity(_stream(spark, sf_dir))
    return io.read_output(spark, io.run_append(rows, "trailing"), rows)


def stream_distinct_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of every window, open ones included."""
    counted = windows.tumbling_merchants(_stream(spark, sf_dir))
    return io.latest_updates(spark, io.run_updates(counted, "merchants"), WINDOW)


def stream_distinct_merchants_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark has closed, each given out once."""
    counted = windows.tumbling_merchants(_stream(spark, sf_dir), closed_only=True)
    return io.read_output(spark, io.run_append(counted, "merchants"), counted)


def stream_velocity_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stateful.trailing_velocity(_stream(spark, sf_dir), 600, "velocity_10min_calc")
    return io.read_output(spark, io.run_append(rows, "trailing"), rows)


def stream_night_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = windows.tumbling_night_ratio(_stream(spark, sf_dir))
    latest = io.latest_updates(spark, io.run_updates(ratio, "night"), WINDOW)
    return rounded(latest, "night_tx_ratio")


def stream_running_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stateful.running_zscore(_stream(spark, sf_dir))
    written = io.read_output(spark, io.run_append(rows, "zscore"), rows)
    return rounded(written.select("transaction_id", "zscore_running"), "zscore_running")


def stream_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _stream(spark, sf_dir)
    kept = stateful.reuse_results(tx, ["user_id", "merchant_category"])
    return io.read_output(spark, io.run_append(kept, "reuse"), kept)


def stream_trailing_velocity_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_trailing_velocity``, on state variables and timers."""
    with variables.with_rocksdb(spark):
        rows = variables.trailing_velocity(_stream(spark, sf_dir))
        return io.read_output(spark, io.run_append(rows, "trailing"), rows)


def stream_running_zscore_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    with variables.with_rocksdb(spark):
        rows = variables.running_zscore(_stream(spark, sf_dir))
        written = io.read_output(spark, io.run_append(rows, "zscore"), rows)
    return rounded(written.select("transaction_id", "zscore_running"), "zscore_running")


def stream_reuse_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    with variables.with_rocksdb(spark):
        kept = variables.reuse_results(_stream(spark, sf_dir), ["user_id", "merchant_category"])
        return io.read_output(spark, io.run_append(kept, "reuse"), kept)


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = derived.requests(_stream(spark, sf_dir))
    model = scoring.linear_model(LINEAR_WEIGHTS, LINEAR_INTERCEPT)
    return pipeline.score_stream(requests, model, LINEAR_THRESHOLD, MODEL_VERSION)


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = _decisions(spark, sf_dir)
    return io.read_output(spark, io.run_append(decisions, "decisions"), decisions)


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = pipeline.running_stats(derived.prediction_log(_stream(spark, sf_dir)))
    written = spark.read.parquet(io.run_updates(stats, "stats", mode="complete"))
    return written.orderBy(F.desc("batch_id")).limit(1).drop("batch_id")


def stream_feature_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = pipeline.upsert_features(_stream(spark, sf_dir))
    return pipeline.current_features(spark, path)


PARTS = 4
#: All files that are there make one micro-batch.
ALL_FILES = 1_000_000


def _deliveries(spark: SparkSession, sf_dir: str, path: str):
    """The events written to ``path`` in four parts of their time, a tenth of each one part later; yields after each."""
    events = read_table(spark, sf_dir, "events").withColumn("s", epoch_seconds(F.col("ts")))
    low, high = events.agg(F.min("s"), F.max("s")).first()
    part = F.floor((F.col("s") - F.lit(low)) * PARTS / F.lit((high or 0) - (low or 0) + 1))
    arrives = F.when(F.col("event_id") % 10 == 0, F.least(part + 1, F.lit(PARTS - 1))).otherwise(part)
    for i in range(PARTS):
        events.where(arrives == i).drop("s").write.parquet(f"{path}/part{i}")
        yield io.transaction_stream(spark, f"{path}/part*", files_per_batch=ALL_FILES)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came more than ten minutes behind the batches before, with the batch that brought them."""
    path = scratch_path(spark, "deliveries")
    for stream in _deliveries(spark, sf_dir, f"{path}/events"):
        found = late.split_late(stream, f"{path}/split")
    rows = spark.read.parquet(found.late)
    return rows.select("transaction_id", F.col("batch_id").cast("long").alias("batch"))


def stream_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest features of every client, merged batch by batch and compacted."""
    path = scratch_path(spark, "deliveries")
    kept = store.Store(spark, f"{path}/store", "client_id", ["updated_at", "last_id"])
    for stream in _deliveries(spark, sf_dir, f"{path}/events"):
        rows = stream.select(
            "client_id", F.col("timestamp").alias("updated_at"), F.col("transaction_id").alias("last_id"),
            F.col("amount").alias("last_amount"),
        )
        store.feed(rows, kept, f"{path}/checkpoint")
    kept.compact()
    return kept.read()


def stream_feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction of a stream with the features that were valid then, out of the versioned store."""
    path = scratch_path(spark, "lookup")
    snapshots = derived.feature_snapshots(as_transactions(read_table(spark, sf_dir, "events"), labelled=False))
    history = store.Store(spark, f"{path}/store", "entry", ["valid_from"])
    history.merge(snapshots.withColumn("entry", F.concat_ws(":", "client_id", "valid_from")), 0)
    tx = _stream(spark, sf_dir).select("transaction_id", "client_id", "timestamp")
    store.lookup(
        tx, history, path, f"{path}/checkpoint",
        lambda batch, features: joins.asof_lookup(batch, features.drop("entry")),
    )
    found = spark.read.parquet(f"{path}/data").drop("batch_id")
    return rounded(found, "avg_amount_day")


STREAMS: dict[str, Query] = {
    "stream_late_rows": stream_late_rows,
    "stream_feature_store": stream_feature_store,
    "stream_feature_lookup": stream_feature_lookup,
    "stream_velocity": stream_velocity,
    "stream_trailing_velocity": stream_trailing_velocity,
    "stream_distinct_merchants": stream_distinct_merchants,
    "stream_distinct_merchants_closed": stream_distinct_merchants_closed,
    "stream_velocity_10min": stream_velocity_10min,
    "stream_night_ratio": stream_night_ratio,
    "stream_running_zscore": stream_running_zscore,
    "stream_reuse": stream_reuse,
    "stream_trailing_velocity_state": stream_trailing_velocity_state,
    "stream_running_zscore_state": stream_running_zscore_state,
    "stream_reuse_state": stream_reuse_state,
    "stream_scoring": stream_scoring,
    "stream_stats": stream_stats,
    "stream_feature_upsert": stream_feature_upsert,
}
