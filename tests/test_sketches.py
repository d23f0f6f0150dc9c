"""Merged daily sketches against exact results."""

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import sketches

POINTS = {"p50": 0.50, "p95": 0.95}


def test_few_values_are_exact_and_many_within_bounds(spark):
    rows = spark.range(400_000).select(
        (F.col("id") % 2).alias("client_id"), (F.col("id") % 10 * 86_400 + 5).alias("timestamp"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 90).otherwise(F.col("id")).alias("merchant_id"))
    got = {(r.client_id, r.day): r.distinct_values for r in sketches.trailing_distinct(sketches.daily_distinct(rows, "merchant_id"), 3).collect()}
    exact = {}
    for day in range(10):
        seen = rows.where(F.floor(F.col("timestamp") / 86_400).between(day - 2, day)).groupBy("client_id").agg(F.countDistinct("merchant_id").alias("n"))
        exact |= {(r.client_id, day): r.n for r in seen.collect()}
    own_days = {(c, d) for c in (0, 1) for d in range(10) if d % 2 == c}
    assert set(got) == own_days  # a client has rows on every other day
    for key in own_days:
        assert got[key] == exact[key] if key[0] == 0 else abs(got[key] / exact[key] - 1) < 0.05


def test_odd_rows_have_no_part_in_sketches(spark):
    rows = spark.createDataFrame(
        [(1, 5, 7.0), (1, None, 7.0), (None, 5, 7.0), (1, 6, None)], "client_id int, timestamp long, v double")
    assert [tuple(r) for r in sketches.trailing_distinct(sketches.daily_distinct(rows, "v"), 7).collect()] == [(1, 0, 1)]
    assert sketches.percentiles(sketches.daily_percentiles(rows.limit(0), "v"), POINTS).first()["n"] is None


@pytest.mark.parametrize("value", ["id", "id % 7", "pow(id % 1000, 3)"])
def test_rank_errors_of_days_and_of_all(spark, value):
    rows = spark.range(60_000).select((F.col("id") * 31 % 3 * 86_400).alias("timestamp"), F.expr(value).cast("double").alias("v"))
    daily = sketches.daily_percentiles(rows.repartition(9), "v")
    for day in sketches.rank_errors(rows, "v", sketches.percentiles(daily, POINTS, "day"), POINTS).collect():
        assert day.p50 < 0.01 and day.p95 < 0.01 and day.n == 20_000
    whole = sketches.percentiles(daily, POINTS).withColumn("day", F.lit(0).cast("long"))
    every = sketches.rank_errors(rows.withColumn("timestamp", F.lit(5)), "v", whole.drop("n"), POINTS).first()
    assert every.p50 < 0.01 and every.p95 < 0.01 and every.n == 60_000
