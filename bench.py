"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then three times; the best of the three counts. The rows
are all produced (``noop`` sink) but not brought to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cardwatch.operators import joins  # noqa: E402
from cardwatch.plans import catalog, streams  # noqa: E402
from cardwatch.session import local_session, scratch_path  # noqa: E402
from cardwatch.sources import derived, lake  # noqa: E402
from cardwatch.sources.tables import transactions  # noqa: E402

HEADLINE = [
    "positive_amount_count",
    "daily_slice_count",
    "velocity_1h",
    "gold_features",
    "gold_features_hot",
    "gold_validation",
    "distinct_trailing",
    "zscore_running",
    "class_distribution",
    "country_fraud_pivot",
    "iqr_outliers",
    "validate_transactions",
    "silver_clean",
    "merchant_enrich",
    "feature_asof",
    "feedback_relabel",
    "roc_curve",
    "auc_roc",
    "calibrated_threshold",
    "anova_topk",
    "score_batch",
    "prediction_stats",
    "recent_predictions",
    "ttl_dedup",
]
STREAMS = ["stream_velocity", "stream_trailing_velocity"]


def timed(run, repeats: int = 3) -> float:
    run()
    best = float("inf")
    for _ in range(repeats):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def produce(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def layout_trials(spark, sf_dir: str) -> dict[str, float]:
    """Full scan against one pruned day, cached against not, hinted join against not."""
    path = scratch_path(spark, "bench")
    lake.write_by_date(transactions(spark, sf_dir), path)
    table = lake.read_lake(spark, path)
    core = table.select("is_fraud", "V14", "V17", "amount")

    def two_means() -> None:
        for c in ("V14", "V17"):
            core.groupBy("is_fraud").agg(F.avg(c)).collect()

    merchants = joins.merchant_table(spark, derived.MERCHANT_ROWS)
    times = {
        "full_scan_count": timed(lambda: table.where("amount > 0").count()),
        "one_day_count": timed(lambda: lake.day_slice(table, catalog.PROBE_DAY).count()),
        "two_means_uncached": timed(two_means),
        "join_planned": timed(lambda: joins.enrich_merchants(table, merchants).count()),
        "join_hinted": timed(lambda: joins.enrich_merchants(table, merchants, True).count()),
    }
    core.persist()
    core.count()
    times["two_means_cached"] = timed(two_means)
    core.unpersist()
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "cardwatch-bench")
    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = timed(lambda q=catalog.BATCH[name]: produce(q(spark, sf_dir)))
    for name in STREAMS:
        times[name] = timed(lambda q=streams.STREAMS[name]: produce(q(spark, sf_dir)), 1)
    times |= layout_trials(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_wall_clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
