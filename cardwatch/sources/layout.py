"""Tables laid out by key, so that work per key needs no exchange.

Rows of a key lie in one bucket, ordered by key and time. Windows and aggregates whose keys contain the bucket key, and joins
of two tables with as many buckets, then read the buckets side by side instead of shuffling. The exchange is paid once, when
the table is written, and again only for what is appended.

One task reads one bucket. ``buckets`` is therefore to be chosen so that a bucket of the whole table fits a task (about a
gigabyte), and a table of which one key holds a large share is better left to the operators that cut keys into blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str = "client_id", order: str = "timestamp", buckets: int = 64
) -> None:
    """Write ``df`` as a table of the catalog with its files under ``path``, one file a bucket."""
    _writer(df, key, order, buckets).option("path", path).mode("error").saveAsTable(table)


def append_bucketed(
    spark: SparkSession, df: DataFrame, table: str, key: str = "client_id", order: str = "timestamp", buckets: int = 64
) -> None:
    """Add rows to a bucketed table; key, order and number of buckets must be those it was written with.

    Every append adds a file to each bucket that it touches; readers still need no exchange.
    """
    columns = spark.table(table).columns
    _writer(df.select(*columns), key, order, buckets).mode("append").saveAsTable(table)


def _writer(df: DataFrame, key: str, order: str, buckets: int):
    # The same hash deals out rows and names buckets, so a task writes one bucket alone.
    return df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key, order)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
