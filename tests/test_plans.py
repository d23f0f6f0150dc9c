"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest

from cardwatch.operators import gold, joins
from cardwatch.plans import catalog
from cardwatch.sources import derived, lake
from cardwatch.sources.tables import read_table, transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_over_the_client_alone(spark, sf_dir):
    text = plan(gold.compute_features(transactions(spark, sf_dir)))
    assert not re.search(r"hashpartitioning\(client_id#\d+L, \d+\)", text)


def test_no_frame_is_summed_again_for_every_row(spark, sf_dir):
    text = plan(gold.compute_features(transactions(spark, sf_dir)))
    frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ([^)]+)\)", text)
    assert frames and all("unboundedpreceding" in f[1] for f in frames)


def test_day_of_a_partitioned_table_is_pruned(spark, sf_dir, tmp_path):
    path = str(tmp_path / "tx")
    lake.write_by_date(transactions(spark, sf_dir), path)
    day = lake.day_slice(lake.read_lake(spark, path), "2024-01-15")
    text = plan(day)
    assert re.search(r"PartitionFilters: \[.*transaction_date.* = 2024-01-15", text)
    assert day.count() == catalog.daily_slice_count(spark, sf_dir).first()["n"]


def test_rewriting_a_day_leaves_other_days(spark, sf_dir, tmp_path):
    path = str(tmp_path / "tx")
    tx = transactions(spark, sf_dir)
    lake.write_by_date(tx, path)
    lake.write_by_date(lake.day_slice(tx, "2024-01-15").limit(1), path)
    written = lake.read_lake(spark, path)
    assert lake.day_slice(written, "2024-01-15").count() == 1
    assert written.where("transaction_date <> '2024-01-15'").count() == tx.where(
        "transaction_date <> '2024-01-15'").count()


def test_day_of_a_plain_table_is_pushed_down(spark, sf_dir):
    text = plan(lake.day_range(read_table(spark, sf_dir, "events"), "ts", "2024-01-15"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_columns_are_pruned(spark, sf_dir):
    text = plan(transactions(spark, sf_dir).select("transaction_id", "amount"))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_merchants_are_broadcast(spark, sf_dir):
    merchants = joins.merchant_table(spark, derived.MERCHANT_ROWS)
    text = plan(joins.enrich_merchants(transactions(spark, sf_dir), merchants, hint=True))
    assert "BroadcastHashJoin" in text


@pytest.mark.parametrize("name", ["iqr_outliers", "feature_asof", "roc_curve", "anova_topk"])
def test_no_cross_join(spark, sf_dir, name):
    text = plan(catalog.BATCH[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_rows_need_no_full_sort(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(catalog.recent_predictions(spark, sf_dir))


def test_distinct_counts_read_their_input_once(spark, sf_dir):
    text = plan(catalog.BATCH["distinct_trailing"](spark, sf_dir))
    for table in ("events", "customer", "nation"):
        assert len(re.findall(rf"FileScan parquet .*?{table}\.parquet", text)) == 1
    assert not re.search(r"hashpartitioning\(k#\d+L?, \d+\)", text)


def test_feature_ranking_needs_no_row_per_feature(spark, sf_dir):
    text = plan(catalog.BATCH["anova_topk"](spark, sf_dir))
    assert "Expand" not in text


def test_gold_features_take_two_exchanges_and_one_scan(spark, sf_dir):
    text = plan(gold.compute_features(transactions(spark, sf_dir)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 2
    assert len(re.findall(r"FileScan parquet", text)) == 1 and "Join" not in text


def test_means_and_deviations_sort_a_task_twice_and_copies_carry_one_value(spark, sf_dir):
    df = transactions(spark, sf_dir)
    text = plan(gold.amount_zscore(df))
    assert len(re.findall(r"Sort \[", text)) <= 2
    # The second sort holds rows only, without their copies.
    second = re.findall(r"(?:Sort|Filter isnotnull|Generate inline)", text)
    assert second[:3] == ["Sort", "Filter isnotnull", "Sort"]


def test_asof_holds_no_array_of_entries(spark, sf_dir):
    text = plan(catalog.BATCH["feature_asof"](spark, sf_dir))
    assert "collect_list" not in text and "Join" not in text


def test_roc_totals_need_no_scan_of_their_own(spark, sf_dir):
    text = plan(catalog.BATCH["roc_curve"](spark, sf_dir))
    # Two branches, each printed with the cuts of its blocks.
    assert len(re.findall(r"FileScan parquet", text)) <= 4
