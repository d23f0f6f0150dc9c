import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import gold, skew, trailing
from cardwatch.operators.trailing import Trailing

SCHEMA = "transaction_id long, client_id long, timestamp long, amount double, hour int, V14 double"
SPECS = [
    Trailing("n_1h", "count", "transaction_id", 3600),
    Trailing("n_10min", "count", "transaction_id", 600),
    Trailing("mean", "avg", "amount", 7 * 86400),
    Trailing("std", "stddev", "amount", 7 * 86400),
]


def make(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        client = None if rng.random() < 0.05 else rng.choice([1, 1, 1, 2, 3, 4])
        at = rng.choice([rng.randrange(0, 4000), rng.randrange(-100, 3_000_000)])
        amount = None if rng.random() < 0.1 else round(rng.uniform(1, 500), 2)
        rows.append((i if rng.random() > 0.1 else None, client, at, amount, at // 3600 % 24, -4.0))
    return rows


def brute(rows):
    out = []
    for _, c, t, *_ in rows:
        def frame(w, c=c, t=t):
            return [r for r in rows if r[1] == c and t - w <= r[2] <= t]

        week = [r[3] for r in frame(7 * 86400) if r[3] is not None]
        out.append(
            (
                sum(r[0] is not None for r in frame(3600)),
                sum(r[0] is not None for r in frame(600)),
                statistics.fmean(week) if week else None,
                statistics.stdev(week) if len(week) > 1 else None,
            )
        )
    return out


def close(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-9))


def test_trailing_equals_brute_force(spark):
    rows = make()
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], SCHEMA + ", k long")
    got = trailing.trailing(df, SPECS).orderBy("k")
    got = [tuple(r) for r in got.select("n_1h", "n_10min", "mean", "std").collect()]
    assert len(got) == len(rows)
    for mine, want in zip(got, brute(rows), strict=True):
        assert all(close(a, b) for a, b in zip(mine, want, strict=True)), (mine, want)


def test_frame_edges_are_inclusive(spark):
    rows = [(1, 7, 0), (2, 7, 3600), (3, 7, 3600), (4, 7, 7201)]
    df = spark.createDataFrame(rows, "transaction_id long, client_id long, timestamp long")
    got = {r["transaction_id"]: r["velocity_1h_calc"] for r in gold.velocity(df).collect()}
    # Exactly 3600 s apart counts, same-second rows count each other, 3601 s does not.
    assert got == {1: 1, 2: 3, 3: 3, 4: 1}


def test_equal_amounts_have_no_spread_in_blocks(spark):
    rows = [(i, 1, i * 50, 19.99, 12, 0.0) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    z = gold.amount_zscore(df)
    assert z.agg(F.max(F.abs("zscore_amount_calc"))).first()[0] < 1e-6


def test_large_values_keep_their_spread_in_blocks(spark):
    rows = [(i, 1, i, 1e9 + i % 2, 12, 0.0) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    spec = [Trailing("std", "stddev", "amount", 86400)]
    got = trailing.trailing(df, spec)
    last = got.where("transaction_id = 99").first()["std"]
    assert math.isclose(last, statistics.stdev([i % 2 for i in range(100)]), rel_tol=1e-6)


def test_single_row_has_zero_zscore(spark):
    df = spark.createDataFrame([(1, 1, 5, 9.0, 1, -4.0)], SCHEMA)
    row = gold.compute_features(df).first()
    assert (row["zscore_amount_calc"], row["velocity_1h_calc"], row["night_tx_ratio"]) == (0, 1, 1)


def test_risk_rules_are_strict_and_ordered(spark):
    rows = [(5, -4.0, 0.5, 0.6), (6, -3.0, 0.4, 0.1), (6, -3.1, 0.9, 0.9), (9, 0.0, 0.41, 0.6)]
    df = spark.createDataFrame(rows, "v long, v14 double, night double, want double")
    got = df.select("want", gold.risk_score(F.col("v"), F.col("v14"), F.col("night")).alias("r"))
    assert all(r["want"] == r["r"] for r in got.collect())


def test_supplied_night_ratio_is_kept(spark):
    df = spark.createDataFrame([(1, 1, 5, 9.0, 1, -4.0)], SCHEMA).withColumn(
        "night_tx_ratio", F.lit(0.41)
    )
    row = gold.compute_features(df).first()
    assert (row["night_tx_ratio"], row["risk_score"]) == (0.41, 0.6)


def test_ten_minutes_never_exceed_the_hour(spark, sf_dir):
    from cardwatch.sources.tables import transactions

    got = gold.compute_features(transactions(spark, sf_dir))
    assert got.where("velocity_10min_calc > velocity_1h_calc").count() == 0


def test_distinct_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [
        (i, rng.choice([1, 1, 1, None, 2]), rng.randrange(0, 400_000), rng.choice("abcde" + "-"))
        for i in range(500)
    ]
    rows = [(i, c, t, None if m == "-" else m) for i, c, t, m in rows]
    df = spark.createDataFrame(
        rows, "transaction_id long, client_id long, timestamp long, merchant string"
    )
    got = trailing.trailing_distinct(df, [("d_1h", "merchant", 3600), ("d_2d", "merchant", 172_800)])
    got = {r["transaction_id"]: (r["d_1h"], r["d_2d"]) for r in got.collect()}
    for i, c, t, _ in rows:
        want = tuple(
            len({r[3] for r in rows if r[1] == c and t - w <= r[2] <= t} - {None})
            for w in (3600, 172_800)
        )
        assert got[i] == want


def test_running_zscore_equals_brute_force(spark):
    rows = [(i, *r[1:]) for i, r in enumerate(make(300, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = trailing.running_zscore(df)
    got = {r["transaction_id"]: r["zscore_running"] for r in got.collect()}
    for i, c, t, x, *_ in rows:
        past = [r[3] for r in rows if r[1] == c and (r[2], r[0]) <= (t, i) and r[3] is not None]
        want = 0.0
        if x is not None and len(past) > 1:
            want = (x - statistics.fmean(past)) / (statistics.stdev(past) + 1e-6)
        assert math.isclose(got[i], want, abs_tol=1e-6)


ODD_VALUES = [float("nan"), float("inf"), float("-inf"), None]


def odd_rows(n=240):
    """Clients of few and of many rows, with odd amounts in some and rows without a time or client."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        amount = rng.choice(ODD_VALUES) if rng.random() < 0.06 else round(rng.uniform(1, 9), 2)
        at = None if rng.random() < 0.05 else rng.randrange(0, 2_000_000)
        rows.append((i, rng.choice([1, 1, 1, 1, 2, 3, None]), at, amount, 1, 0.0))
    return rows


def moments(values):
    """Mean and sample deviation as SQL has them."""
    values = [v for v in values if v is not None]
    if all(math.isfinite(v) for v in values):
        return (statistics.fmean(values) if values else None, statistics.stdev(values) if len(values) > 1 else None)
    up, down = float("inf") in values, float("-inf") in values
    nan = any(v != v for v in values) or (up and down)
    mean = float("nan") if nan else float("inf" if up else "-inf")
    return mean, float("nan") if len(values) > 1 else None


def alike(a, b):
    return (a is None) == (b is None) and (a is None or (a != a and b != b) or a == b or math.isclose(a, b, abs_tol=1e-6))


def test_odd_values_reach_only_their_frames(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["transaction_id"]: (r["mean"], r["std"]) for r in trailing.trailing(df, SPECS[2:]).collect()}
    for i, c, t, *_ in rows:
        frame = [r[3] for r in rows if r[1] == c and (
            r[2] is None if t is None else r[2] is not None and t - 7 * 86400 <= r[2] <= t)]
        assert all(alike(a, b) for a, b in zip(got[i], moments(frame), strict=True)), (i, got[i], moments(frame))


def test_odd_values_in_the_running_score(spark):
    rows = [r for r in odd_rows() if r[2] is not None]
    for block in (60, 86_400, 10**9):
        df = spark.createDataFrame(rows, SCHEMA)
        got = {r["transaction_id"]: r["zscore_running"] for r in trailing.running_zscore(df, block_seconds=block).collect()}
        for i, c, t, x, *_ in rows:
            mean, std = moments([r[3] for r in rows if r[1] == c and (r[2], r[0]) <= (t, i)])
            want = 0.0 if x is None or mean is None or std is None else (x - mean) / (std + 1e-6)
            assert alike(got[i], want), (block, i)


def test_running_totals_descending(spark):
    df = spark.createDataFrame([(i, i // 3, 1) for i in range(10)], "x int, block int, n int")
    got = skew.running_totals(df, "x", "block", ["n"], descending=True)
    assert all(r["cum_n"] == 10 - r["x"] for r in got.collect())
