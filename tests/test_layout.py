"""Tables laid out by key: the same rows, and no exchange once they are written."""

import uuid

import pytest

from cardwatch.operators import gold, joins, trailing
from cardwatch.sources import derived, layout
from cardwatch.sources.tables import transactions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def bucketed(spark, tmp_path):
    names = []

    def write(df, order="timestamp", buckets=4):
        names.append(f"t_{uuid.uuid4().hex}")
        layout.write_bucketed(df, names[-1], str(tmp_path / names[-1]), order=order, buckets=buckets)
        return names[-1]

    yield write
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_gold_needs_no_exchange(spark, sf_dir, bucketed):
    tx = transactions(spark, sf_dir)
    got = gold.compute_features(layout.read_bucketed(spark, bucketed(tx)))
    assert "Exchange" not in plan(got)
    columns = ["transaction_id", "client_id", "velocity_1h_calc", "velocity_10min_calc", "night_tx_ratio"]
    want = gold.compute_features(tx).select(columns)
    assert got.count() == tx.count() and got.select(columns).exceptAll(want).count() == 0


def test_asof_between_two_tables_needs_no_exchange(spark, sf_dir, bucketed):
    tx = transactions(spark, sf_dir, labelled=False)
    rows = tx.select("transaction_id", "client_id", "timestamp")
    history = derived.feature_snapshots(tx)
    got = joins.asof_lookup(
        layout.read_bucketed(spark, bucketed(rows)), layout.read_bucketed(spark, bucketed(history, "valid_from"))
    )
    assert "Exchange" not in plan(got)
    kept = ["transaction_id", "tx_count_day"]
    want = joins.asof_lookup(rows, history).select(kept)
    assert got.count() == rows.count() and got.select(kept).exceptAll(want).count() == 0


def test_distinct_counts_need_no_exchange_by_client(spark, sf_dir, bucketed):
    tx = layout.read_bucketed(spark, bucketed(transactions(spark, sf_dir)))
    got = trailing.trailing_distinct(tx, [("n", "merchant_id", 86_400)])
    assert "Exchange" not in plan(got)


def test_appended_rows_keep_the_layout(spark, bucketed):
    types = "transaction_id long, client_id long, timestamp long, amount double, hour int, V14 double"
    first = spark.createDataFrame([(1, 7, 100, 1.0, 3, 0.0), (2, None, 100, 2.0, 3, 0.0)], types)
    table = bucketed(first)
    # Columns in another order are put in place by name.
    more = spark.createDataFrame([(3, 7, 200, 3.0, 12, 0.0)], types).select(*reversed(first.columns))
    layout.append_bucketed(spark, more, table, buckets=4)
    got = gold.compute_features(layout.read_bucketed(spark, table))
    assert "Exchange" not in plan(got)
    found = {r["transaction_id"]: (r["velocity_1h_calc"], r["night_tx_ratio"]) for r in got.collect()}
    assert found == {1: (1, 1.0), 2: (1, 1.0), 3: (2, 0.5)}


def test_an_empty_table_stays_empty(spark, sf_dir, bucketed):
    none = transactions(spark, sf_dir).limit(0)
    assert gold.compute_features(layout.read_bucketed(spark, bucketed(none))).count() == 0
