"""Streams over several files, hence several micro-batches, against the batch operators."""

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators import gold, monitoring, reuse, scoring, trailing
from cardwatch.plans import common
from cardwatch.sources import derived
from cardwatch.sources.tables import as_transactions, read_table
from cardwatch.streaming import io, pipeline, stateful, windows

WINDOW = ["client_id", "window_start", "window_end"]


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The events cut into four files in time order, named so that they arrive in order."""
    path = tmp_path_factory.mktemp("stream")
    pdf = read_table(spark, sf_dir, "events").orderBy("ts", "event_id").toPandas()
    step = -(-len(pdf) // 4)
    for i in range(4):
        part = spark.createDataFrame(pdf.iloc[i * step:(i + 1) * step], schemas.EVENTS)
        part.coalesce(1).write.parquet(str(path / f"part{i}"))
    return f"{path}/part*"


@pytest.fixture
def stream(spark, folder):
    return io.transaction_stream(spark, folder, files_per_batch=1)


@pytest.fixture(scope="module")
def batch(spark, sf_dir):
    tx = as_transactions(read_table(spark, sf_dir, "events"))
    rows = tx.withColumn("at", F.timestamp_seconds("timestamp")).cache()
    yield rows
    rows.unpersist()


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sliding_velocity(spark, stream, batch):
    path = io.run_updates(windows.sliding_velocity(stream), "velocity")
    assert spark.read.parquet(path).select("batch_id").distinct().count() > 1
    assert same(io.latest_updates(spark, path, WINDOW), windows.sliding_velocity(batch))


def test_append_mode_gives_closed_windows_once(spark, stream, batch):
    got = spark.read.parquet(io.run_append(windows.tumbling_merchants(stream, closed_only=True), "m"))
    limit = batch.agg(F.max("timestamp")).first()[0] - 600
    want = windows.tumbling_merchants(batch).where(F.col("window_end") <= limit)
    assert want.count() > 0 and same(got, want)


def test_night_ratio(spark, stream, batch):
    path = io.run_updates(windows.tumbling_night_ratio(stream), "night")
    round_it = F.round("night_tx_ratio", 9).alias("night_tx_ratio")
    assert same(
        io.latest_updates(spark, path, WINDOW).select(*WINDOW, round_it),
        windows.tumbling_night_ratio(batch).select(*WINDOW, round_it),
    )


def test_exact_trailing_velocity(spark, stream, batch):
    got = spark.read.parquet(io.run_append(stateful.trailing_velocity(stream), "t"))
    want = gold.velocity(batch).select(*got.columns)
    assert same(got, want)


def test_running_zscore(spark, stream, batch):
    got = spark.read.parquet(io.run_append(stateful.running_zscore(stream), "z"))
    want = trailing.running_zscore(batch)
    both = got.join(want.select("transaction_id", F.col("zscore_running").alias("w")),
                    "transaction_id")
    assert both.count() == batch.count()
    assert both.agg(F.max(F.abs(F.col("zscore_running") - F.col("w")))).first()[0] < 1e-6


def test_result_reuse(spark, stream, batch):
    keys = ["user_id", "merchant_category"]
    got = spark.read.parquet(io.run_append(stateful.reuse_results(stream, keys), "r"))
    assert same(got, reuse.ttl_dedup(batch, keys).select(*got.columns))


def test_scoring(spark, stream, batch):
    model = scoring.linear_model(common.LINEAR_WEIGHTS, common.LINEAR_INTERCEPT)
    scored = pipeline.score_stream(derived.requests(stream), model, 0.5, "v")
    got = spark.read.parquet(io.run_append(scored, "d"))
    assert same(got, scoring.score_batch(derived.requests(batch), model, 0.5, "v"))


def test_bronze_is_partitioned_and_complete(spark, stream, batch, tmp_path):
    path = str(tmp_path / "bronze")
    io.append_bronze(stream.drop("at"), path, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(path)
    assert same(got, batch.drop("at").select(*got.columns))
    assert len(list((tmp_path / "bronze").glob("transaction_date=*"))) == (
        batch.select("transaction_date").distinct().count())


def test_decisions_become_messages(spark):
    df = spark.createDataFrame([("a", True)], "transaction_id string, is_fraud boolean")
    row = io.encode_decisions(df).first()
    assert (row["key"], row["value"]) == ("a", '{"transaction_id":"a","is_fraud":true}')


def test_running_stats(spark, stream, batch):
    path = io.run_updates(
        pipeline.running_stats(derived.prediction_log(stream)), "s", mode="complete")
    last = spark.read.parquet(path).orderBy(F.desc("batch_id")).limit(1).drop("batch_id")
    assert same(last, monitoring.prediction_stats(derived.prediction_log(batch)))


def test_features_are_upserted_and_looked_up(spark, stream, batch):
    current = pipeline.current_features(spark, pipeline.upsert_features(stream))
    want = batch.groupBy("client_id").agg(
        F.max("timestamp").alias("updated_at"), F.count(F.lit(1)).alias("n_seen"))
    assert same(current.select("client_id", "updated_at", "n_seen"), want)
    joined = pipeline.lookup_features(batch, current)
    assert joined.count() == batch.count() and joined.where("n_seen IS NULL").count() == 0


def test_late_row_is_left_out(spark, tmp_path):
    day = "timestamp_ntz '2024-01-01 {}'"
    parts = [["12:00:00"], ["14:00:00"], ["14:05:00"], ["12:01:00", "15:30:00"]]
    for i, times in enumerate(parts):
        rows = " UNION ALL ".join(
            f"SELECT {10 * i + j}L event_id, {day.format(t)} ts, 1L user_id, 'view' event_type, "
            "1.0D value, '{\"k\": 1}' props"
            for j, t in enumerate(times)
        )
        spark.sql(rows).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
    tx = io.transaction_stream(spark, f"{tmp_path}/part*", files_per_batch=1)
    counted = windows.sliding_velocity(tx, "1 hour", "1 hour")
    got = spark.read.parquet(io.run_append(counted, "late"))
    # The second row of noon came when the watermark had passed 13:00.
    velocities = [r["velocity"] for r in got.orderBy("window_start").collect()]
    assert velocities == [1, 2]


def _odd_events(spark, path):
    """Two files in which some rows lack the time or hold amounts that are no usual numbers."""
    odd = {3: float("nan"), 11: float("inf"), 17: None, 23: float("-inf")}
    base = 1_700_000_000
    for part in range(2):
        rows = []
        for i in range(part * 15, part * 15 + 15):
            at = None if i in (5, 20) else F.timestamp_seconds(F.lit(base + 60 * i))
            rows.append((i, at, i % 2, odd.get(i, float(i))))
        df = None
        for i, at, client, amount in rows:
            row = spark.range(1).select(
                F.lit(i).cast("long").alias("transaction_id"), F.lit(client).cast("long").alias("client_id"),
                (F.lit(None) if at is None else F.lit(base + 60 * i)).cast("long").alias("timestamp"),
                F.lit(amount).cast("double").alias("amount"),
            )
            df = row if df is None else df.union(row)
        df.coalesce(1).write.parquet(f"{path}/part{part}")
    return f"{path}/part*"


def test_odd_rows_on_a_stream(spark, tmp_path):
    schema = "transaction_id long, client_id long, timestamp long, amount double"
    folder = _odd_events(spark, str(tmp_path))
    batch = spark.read.schema(schema).parquet(folder)
    stream = io.file_stream(spark, folder, batch.schema, 1)
    stream = stream.withColumn("at", F.timestamp_seconds("timestamp")).withWatermark("at", "10 minutes")
    got = spark.read.parquet(io.run_append(stateful.trailing_velocity(stream), "t"))
    timed = batch.where("timestamp IS NOT NULL")
    assert same(got.where("timestamp IS NOT NULL"), gold.velocity(timed).select(*got.columns))
    assert {r[0] for r in got.where("velocity_1h_calc IS NULL").select("transaction_id").collect()} == {5, 20}
    timed_stream = stream.where("timestamp IS NOT NULL")
    scored = spark.read.parquet(io.run_append(stateful.running_zscore(timed_stream), "z"))
    want = {r["transaction_id"]: r["zscore_running"] for r in trailing.running_zscore(timed).collect()}
    for r in scored.collect():
        w = want[r["transaction_id"]]
        assert (w != w and r["zscore_running"] is None) or abs(w - r["zscore_running"]) < 1e-6
    kept = io.read_output(spark, io.run_append(stateful.reuse_results(stream, ["client_id"]), "r"), stateful.reuse_results(stream, ["client_id"]))
    assert kept.where("timestamp IS NULL").count() == 0 and kept.count() == 2


def test_reuse_takes_many_keys_in_one_call(spark, tmp_path, monkeypatch):
    """One call handles a bucket of keys, null ones and null ids among them."""
    monkeypatch.setattr(stateful, "BUCKETS", 1)
    big = 2**53 + 1
    rows = [(big, "a", 0, big + 2), (big, "a", 10, 2), (big, "a", 3600, 3), (None, "a", 5, 4), (None, "a", 6, 5),
            (7, None, 5, None), (7, None, 5, 6), (7, "b", 9, None), (7, "b", None, 8)]
    schema, start = "user_id long, kind string, timestamp long, transaction_id long", 1_000_000
    spark.createDataFrame(rows, schema).withColumn("timestamp", F.col("timestamp") + start).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = io.file_stream(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
    stream = stream.withColumn("at", F.timestamp_seconds("timestamp")).withWatermark("at", "10 minutes")
    dealt = stateful.reuse_buckets(stream, ["user_id", "kind"], ["user_id", "kind", "timestamp", "transaction_id"])
    found = spark.read.schema(dealt.schema).parquet(io.run_append(dealt, "dealt"))
    assert found.select("_bucket", "_absent").distinct().count() == 3
    kept = stateful.reuse_results(stream, ["user_id", "kind"])
    got = io.read_output(spark, io.run_append(kept, "kept"), kept)
    want = {(big, "a", 0, big + 2), (big, "a", 3600, 3), (None, "a", 5, 4), (7, None, 5, 6), (7, "b", 9, None)}
    assert {(r["user_id"], r["kind"], r["timestamp"] - start, r["transaction_id"]) for r in got.collect()} == want
