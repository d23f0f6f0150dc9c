"""Date-partitioned tables: overwrite, append, pruned reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION = "transaction_date"


def write_by_date(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite the days that ``df`` holds and leave other days alone.

    Rows are rebalanced by day: adaptive execution splits a large day over several tasks and
    merges small ones, so files come out near the advisory size at any volume.
    """
    (
        df.hint("rebalance", PARTITION)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .save(path)
    )


def append_by_date(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append raw rows, partitioned by date."""
    df.hint("rebalance", PARTITION).write.format(fmt).mode("append").partitionBy(PARTITION).save(path)


def read_lake(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def day_slice(df: DataFrame, day: str) -> DataFrame:
    """Rows of one day; on a date-partitioned table only that day's folder is read."""
    return df.where(F.col(PARTITION) == F.to_date(F.lit(day)))


def day_range(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of one day of an unpartitioned table, as bounds that reach the Parquet scan."""
    start = F.lit(day).cast("timestamp_ntz")
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= start) & (F.col(ts) < end))


def table_shape(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns the table has."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )
