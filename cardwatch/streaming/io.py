"""Stream sources and sinks.

A file stream stands in for a message topic; with the connector on the class path the same
operators take ``spark.readStream.format("kafka")`` and ``requests.parse_requests``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schemas
from cardwatch.session import scratch_path
from cardwatch.sources.lake import PARTITION
from cardwatch.sources.tables import as_transactions

LATENESS = "10 minutes"

#: Bounds a micro-batch, and with it the rows that one client can have in it.
FILES_PER_BATCH = 16


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """New Parquet files as they arrive; the batch size is bounded by the number of files."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def topic_stream(spark: SparkSession, servers: str, topic: str, rows_per_batch: int) -> DataFrame:
    """Message values of a Kafka topic as text; needs the connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .load()
        .select(F.col("value").cast("string").alias("body"))
    )


def transaction_stream(
    spark: SparkSession, path: str, lateness: str = LATENESS, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Transactions with the event time ``at`` and its watermark."""
    tx = as_transactions(file_stream(spark, path, schemas.EVENTS, files_per_batch))
    return tx.withColumn("at", F.timestamp_seconds("timestamp")).withWatermark("at", lateness)


def encode_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions as message key and JSON value."""
    return decisions.select(
        F.col("transaction_id").cast("string").alias("key"),
        F.to_json(F.struct(*decisions.columns)).alias("value"),
    )


def write_topic(
    decisions: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send decisions to a Kafka topic; needs the connector on the class path."""
    return (
        encode_decisions(decisions)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def append_bronze(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append raw rows of a stream to a date-partitioned table, once for what is there."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(PARTITION)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_append(stream: DataFrame, name: str) -> str:
    """Process what is there in append mode and return the path of the output table."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{out}/data"


def read_output(spark: SparkSession, path: str, stream: DataFrame) -> DataFrame:
    """What a stream wrote, by the stream's schema, so that a run without rows reads as empty."""
    return spark.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, name: str, mode: str = "update") -> str:
    """Process what is there and keep the changed rows of every batch, tagged with the batch.

    A batch that is repeated after a failure overwrites its own folder.
    """
    spark = stream.sparkSession
    out = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{out}/data"


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current state of a table written by ``run_updates``: the last row of each key."""
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "newest.*")
