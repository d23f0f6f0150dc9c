"""Operators on state variables against the batch operators, over several micro-batches."""

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import gold, reuse, trailing
from cardwatch.streaming import io, variables
from tests.test_streaming import batch, folder, same, stream  # noqa: F401


@pytest.fixture(autouse=True)
def rocksdb(spark):
    before = spark.conf.get(variables.PROVIDER)
    with variables.with_rocksdb(spark):
        yield
    assert spark.conf.get(variables.PROVIDER) == before


def test_velocity_over_batches(spark, stream, batch):  # noqa: F811
    got = spark.read.parquet(io.run_append(variables.trailing_velocity(stream), "t"))
    assert same(got, gold.velocity(batch).select(*got.columns))


def test_zscore_over_batches(spark, stream, batch):  # noqa: F811
    got = spark.read.parquet(io.run_append(variables.running_zscore(stream), "z"))
    want = trailing.running_zscore(batch).select("transaction_id", F.col("zscore_running").alias("w"))
    both = got.join(want, "transaction_id")
    assert both.count() == batch.count()
    assert both.agg(F.max(F.abs(F.col("zscore_running") - F.col("w")))).first()[0] < 1e-6


def test_reuse_over_batches(spark, stream, batch):  # noqa: F811
    keys = ["user_id", "merchant_category"]
    got = spark.read.parquet(io.run_append(variables.reuse_results(stream, keys), "r"))
    assert same(got, reuse.ttl_dedup(batch, keys).select(*got.columns))


def _delivered(spark, path, deliveries):
    """A stream of one file per delivery of (id, client, second, amount)."""
    types = "transaction_id long, client_id long, timestamp long, amount double"
    for i, rows in enumerate(deliveries):
        spark.createDataFrame(rows, types).coalesce(1).write.parquet(f"{path}/part{i}")
    tx = io.file_stream(spark, f"{path}/part*", spark.createDataFrame([], types).schema, 1)
    return tx.withColumn("at", F.timestamp_seconds("timestamp")).withWatermark("at", io.LATENESS)


def test_rows_late_but_within_the_watermark_are_counted(spark, tmp_path):
    tx = _delivered(spark, tmp_path, [
        [(1, 7, 10_000, 1.0), (2, 7, 10_000, 1.0), (3, None, 10_000, 1.0)],
        [(4, 7, 9_800, 1.0), (None, 7, 10_100, 1.0), (5, 7, 10_200, 1.0)],
        [(6, 8, 90_000, 1.0)],
        [(7, 7, 90_100, 1.0), (8, 7, None, 1.0)],
    ])
    got = spark.read.parquet(io.run_append(variables.trailing_velocity(tx), "late")).collect()
    found = {r["transaction_id"]: r["velocity_1h_calc"] for r in got}
    # A row is counted against what had come by its batch; the one without an id is not counted itself.
    assert found == {1: 2, 2: 2, 3: 1, 4: 1, None: 3, 5: 4, 6: 1, 7: 1, 8: None}


def test_unusual_amounts_spoil_later_scores_only(spark, tmp_path):
    nan = float("nan")
    tx = _delivered(spark, tmp_path, [[(1, 7, 1, 2.0), (2, 7, 2, 4.0)], [(3, 7, 3, None), (4, 7, 4, nan)], [(5, 7, 5, 3.0)]])
    got = spark.read.parquet(io.run_append(variables.running_zscore(tx), "odd")).collect()
    found = {r["transaction_id"]: r["zscore_running"] for r in got}
    assert found[1] == 0.0 and found[3] == 0.0 and found[4] is None and found[5] is None
    assert found[2] == pytest.approx((4 - 3) / 2**0.5, rel=1e-6)


def test_timers_delete_what_no_frame_reaches(spark, tmp_path):
    tx = _delivered(spark, tmp_path, [
        [(1, 7, 10_000, 1.0), (2, 8, 10_000, 1.0)], [(3, 8, 60_000, 1.0)], [(4, 8, 60_001, 1.0)], [(5, 8, 60_002, 1.0)],
    ])
    rows = variables.trailing_velocity(tx)
    path = io.run_append(rows, "timers").removesuffix("/data")
    state = spark.read.format("statestore").option("stateVarName", "counts").load(f"{path}/checkpoint")
    left = state.select("key.client_id", "user_map_key.at").collect()
    assert left and all(r["client_id"] == 8 and r["at"] >= 60_000 for r in left)


def test_reuse_state_ends(spark, tmp_path):
    tx = _delivered(spark, tmp_path, [
        [(1, 7, 10_000, 1.0), (2, 7, 13_599, 1.0)], [(3, 7, 13_600, 1.0), (4, 8, 13_600, 1.0)],
        [(5, 8, 60_000, 1.0)], [(6, 8, 60_001, 1.0), (7, 8, None, 1.0)], [(8, 8, 64_000, 1.0)],
    ])
    path = io.run_append(variables.reuse_results(tx, ["client_id"]), "reuse")
    assert sorted(r["transaction_id"] for r in spark.read.parquet(path).collect()) == [1, 3, 4, 5, 8]
    checkpoint = path.removesuffix("/data") + "/checkpoint"
    state = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    assert [r[0] for r in state.select("key.client_id").collect()] == [8]
