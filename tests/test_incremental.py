"""Gold for changed days only, against the full rebuild."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardwatch.operators import gold, incremental
from cardwatch.sources import lake
from cardwatch.sources.tables import transactions

DAY = dt.date(2024, 1, 15)


def test_ranges_join_where_they_touch():
    d = lambda n: DAY + dt.timedelta(n)
    assert incremental.ranges([d(0), d(3), d(20), d(0)], 1, 2) == [(d(-1), d(5)), (d(19), d(22))]
    assert incremental.ranges([d(0), d(4)], 0, 3) == [(d(0), d(7))]
    assert incremental.ranges([], 1, 1) == []


def rows(path, spark):
    return lake.read_lake(spark, path).select(
        "transaction_id", "transaction_date", "velocity_1h_calc", F.round("avg_amount_7d_calc", 6).alias("avg"), "risk_score")


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def week(df):
    """The features whose frames reach back seven days at most."""
    return gold.compute_features(df.withColumn("night_tx_ratio", F.lit(0.1)))


def test_equals_the_full_rebuild_after_deliveries_and_a_loss(spark, sf_dir, tmp_path):
    tx = transactions(spark, sf_dir)
    source, made, full = (f"{tmp_path}/{n}" for n in ("source", "gold", "full"))
    late = (F.col("transaction_date") == F.lit(DAY)) & (F.col("transaction_id") % 2 == 0)
    odd = F.col("transaction_id") % 50 == 3  # later these come without a day
    lake.append_by_date(tx.where(~late & ~odd), source)
    lake.write_by_date(week(lake.read_lake(spark, source)), made)
    untouched = files(lake.read_lake(spark, made).where(F.col("transaction_date") < F.lit(DAY)))
    first = tx.where(late)
    lake.append_by_date(first, source)
    days = incremental.rebuild(lake.read_lake(spark, source), made, incremental.changed_days(first), week, 7)
    assert days == [(DAY, DAY + dt.timedelta(7))]
    assert untouched and untouched <= files(lake.read_lake(spark, made))  # files of earlier days are those of before
    second = tx.where(odd & ~late).withColumns({"transaction_date": F.lit(None).cast("date"), "timestamp": F.lit(None).cast("long")})
    lake.append_by_date(second, source)
    assert incremental.rebuild(lake.read_lake(spark, source), made, incremental.changed_days(second), week, 7) == []
    lake.write_by_date(week(lake.read_lake(spark, source)), full)
    assert same(rows(made, spark), rows(full, spark))
    gone = dt.date(2024, 1, 20)
    incremental.drop_day(spark, source, gone)
    incremental.rebuild(lake.read_lake(spark, source), made, [gone], week, 7)
    assert rows(made, spark).where(F.col("transaction_date") == F.lit(gone)).count() == 0
    lake.write_by_date(week(lake.read_lake(spark, source)), f"{full}2")
    assert same(rows(made, spark), rows(f"{full}2", spark))


def test_only_the_days_in_reach_are_read(spark, sf_dir, tmp_path):
    lake.append_by_date(transactions(spark, sf_dir), f"{tmp_path}/source")
    read = incremental.source_rows(lake.read_lake(spark, f"{tmp_path}/source"), [DAY], 3)
    days = {f.split("transaction_date=")[1][:10] for f in files(read)}
    assert days == {(DAY + dt.timedelta(n)).isoformat() for n in range(-3, 4)}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "transaction_date" in plan.split("PartitionFilters: [")[1][:200]


def test_nothing_changed(spark, tmp_path):
    assert incremental.rebuild(None, str(tmp_path), []) == []


@pytest.mark.parametrize("frame", [gold.NIGHT_RATIO_30D, gold.AVG_AMOUNT_7D, gold.VELOCITY_1H])
def test_frame_days_cover_every_frame(frame):
    assert frame.seconds <= incremental.FRAME_DAYS * 86_400
