import random

import pytest

from cardwatch.operators import joins, monitoring, reuse
from cardwatch.functions import display
from pyspark.sql import functions as F


def test_asof_equals_brute_force(spark):
    rng = random.Random(8)
    key = lambda: rng.choice([1, 1, 2, None])
    rows = [(i, key(), rng.randrange(0, 2_000_000)) for i in range(300)]
    past = {(key(), rng.randrange(0, 1_500_000)): float(i) for i in range(60)}
    df = spark.createDataFrame(rows, "transaction_id long, client_id long, timestamp long")
    history = spark.createDataFrame(
        [(c, t, v) for (c, t), v in past.items()], "client_id long, valid_from long, x double")
    got = {r["transaction_id"]: r["x"] for r in joins.asof_lookup(df, history).collect()}
    for i, c, t in rows:
        known = [(t0, v) for (c0, t0), v in past.items() if c0 == c and t0 <= t]
        assert got[i] == (max(known)[1] if known else None)


def test_asof_is_valid_from_its_own_second(spark):
    df = spark.createDataFrame([(1, 7, 99), (2, 7, 100)],
                               "transaction_id long, client_id long, timestamp long")
    history = spark.createDataFrame([(7, 100, 1.5)], "client_id long, valid_from long, x double")
    got = {r["transaction_id"]: r["x"] for r in joins.asof_lookup(df, history).collect()}
    assert got == {1: None, 2: 1.5}


def test_asof_without_times_keys_or_history(spark):
    df = spark.createDataFrame([(1, None, 5), (2, 7, None), (3, 7, 200_000), (4, 8, 5), (4, 8, 5)],
                               "transaction_id long, client_id long, timestamp long")
    types = "client_id long, valid_from long, x double"
    history = spark.createDataFrame([(None, 1, 1.0), (7, None, 2.0), (7, 1, 3.0), (7, 1, 4.0), (7, 9, None)], types)
    got = joins.asof_lookup(df, history)
    assert got.columns == ["transaction_id", "client_id", "timestamp", "x"]
    # The entry of second 9 is the newest and says null.
    assert sorted((r["transaction_id"], r["x"]) for r in got.collect()) == [
        (1, 1.0), (2, None), (3, None), (4, None), (4, None)]
    empty = joins.asof_lookup(df, spark.createDataFrame([], types))
    assert [r["x"] for r in empty.collect()] == [None] * 5


def test_latest_feedback_wins(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "transaction_id long, is_fraud int")
    feedback = spark.createDataFrame(
        [(1, True, "a", 1), (1, False, "b", 2), (2, False, "a", 1)],
        "transaction_id long, true_label boolean, operator_id string, version long")
    got = {r[0]: (r[1], r[2]) for r in joins.relabel(df, feedback).collect()}
    assert got == {1: (0, True), 2: (0, True), 3: (1, False)}


def brute_reuse(rows, lifetime):
    last, kept = {}, []
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        if k not in last or t >= last[k] + lifetime:
            last[k] = t
            kept.append((k, t, i))
    return sorted(kept, key=str)


@pytest.mark.parametrize("segment", [3600, 10_000, 86_400])
def test_reuse_equals_brute_force(spark, segment):
    rng = random.Random(5)
    shapes = [(3000, 40_000), (200, 900_000), (5, 100), (400, 3_000_000), (1, 10), (2000, 2000)]
    rows = [
        (None if k == 2 else k, 1_000_000 + rng.randrange(span), 0)
        for k, (n, span) in enumerate(shapes)
        for _ in range(n)
    ]
    rows = [(k, t, i) for i, (k, t, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, timestamp long, transaction_id long")
    got = reuse.ttl_dedup(df, ["k"], segment=segment)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_reuse(rows, 3600)


def test_reuse_boundary(spark):
    rows = [("a", 0, 1), ("a", 3599, 2), ("a", 3600, 3), ("a", 7199, 4), ("b", 7200, 5)]
    df = spark.createDataFrame(rows, "k string, timestamp long, transaction_id long")
    got = reuse.ttl_dedup(df, ["k"]).collect()
    # The second row is reused; a row exactly one lifetime after the first is scored again.
    assert sorted(r["transaction_id"] for r in got) == [1, 3, 5]


LOG = ("transaction_id long, timestamp long, fraud_probability double, is_fraud boolean, "
       "latency_ms double, failed boolean, risk_level string")


def test_empty_log_gives_zeros(spark):
    row = monitoring.prediction_stats(spark.createDataFrame([], LOG)).first()
    assert set(row.asDict().values()) == {0}


def test_display(spark):
    rows = [(123456789012, 5, 0.1225, True, 12.5, False, "LOW"),
            (77, 6, 0.9, False, 1.0, False, "HIGH")]
    got = monitoring.display_rows(spark.createDataFrame(rows, LOG)).collect()
    assert [r["id_label"] for r in got] == ["77", "56789012"]
    assert [r["probability_text"] for r in got] == ["90.0%", "12.3%"]
    assert [r["decision_text"] for r in got] == ["LÉGIT", "FRAUDE"]


def test_levels_are_strict(spark):
    rows = [(0.70, "MEDIUM"), (0.7001, "HIGH"), (0.30, "LOW"), (0.3001, "MEDIUM")]
    df = spark.createDataFrame(rows, "p double, want string")
    assert all(r[0] == r[1] for r in
               df.select("want", display.risk_level(F.col("p"))).collect())
