"""Larger trials on one machine: copies of the events as a date-partitioned table.

``SCALE_COPIES`` copies of every client make the scan table; ``SCALE_GOLD_COPIES`` copies go
through the gold features, once as they are and once with a third of all rows on one client.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cardwatch.operators import gold  # noqa: E402
from cardwatch.plans.catalog import PROBE_DAY  # noqa: E402
from cardwatch.session import local_session, scratch_path  # noqa: E402
from cardwatch.sources import lake  # noqa: E402
from cardwatch.sources.tables import transactions  # noqa: E402


def copies(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    # Spread the single input file over the cores before it is multiplied.
    tx = transactions(spark, sf_dir).repartition(8 * spark.sparkContext.defaultParallelism)
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    many = tx.withColumn("copy", F.explode(numbers))
    return many.withColumns(
        {
            "transaction_id": F.col("transaction_id") + F.col("copy") * 10**9,
            "client_id": F.col("client_id") + F.col("copy") * 10**6,
        }
    )


def clock(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def produce(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "cardwatch-scale")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    times: dict[str, float] = {}

    path = scratch_path(spark, "scale")
    times["write"] = clock(
        lambda: lake.write_by_date(
            copies(spark, sf_dir, int(os.environ.get("SCALE_COPIES", "500"))), path
        )
    )
    table = lake.read_lake(spark, path)
    rows = table.count()
    times["full_scan_count"] = clock(lambda: table.where("amount > 0").count())
    times["one_day_count"] = clock(lambda: lake.day_slice(table, PROBE_DAY).count())
    core = table.select("is_fraud", "V14", "V17", "amount")

    def two_means() -> None:
        for c in ("V14", "V17"):
            core.groupBy("is_fraud").agg(F.avg(c)).collect()

    times["two_means_uncached"] = clock(two_means)
    core.persist()
    core.count()
    times["two_means_cached"] = clock(two_means)
    core.unpersist()

    n_gold = int(os.environ.get("SCALE_GOLD_COPIES", "50"))
    even = table.where(F.col("copy") < n_gold)
    gold_rows = even.count()
    times["gold_even"] = clock(lambda: produce(gold.compute_features(even)))
    hot = even.withColumn(
        "client_id", F.when(F.col("copy") % 3 == 0, F.lit(0)).otherwise(F.col("client_id"))
    )
    times["gold_third_on_one_client"] = clock(lambda: produce(gold.compute_features(hot)))
    print(json.dumps({"rows": rows, "gold_rows": gold_rows, "seconds": times}))
    spark.stop()


if __name__ == "__main__":
    main()
