"""Rows that come behind the watermark: counted and kept beside the table instead of dropped unseen."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "batch_id long, latest timestamp, n long, n_late long"


@dataclass(frozen=True)
class Outcome:
    """Folders of the rows in time, of the late rows and of a line per batch."""

    in_time: str
    late: str
    marks: str


def split_late(stream: DataFrame, out: str, lateness_seconds: int = 600, at: str = "at") -> Outcome:
    """Run a stream to its end, with its state under ``out``; each micro-batch is split by the latest event time of the batches before it.

    A row is late if its time is more than the lateness before that. The latest time of each batch is a line of a written
    table, so a restarted query goes on where it was, and a batch that is repeated overwrites its own folders and decides
    as it did. Rows without a time are late once there is a watermark. Event time and lateness are those of the stream;
    its own watermark is not used, since what it drops is gone.
    """
    spark = stream.sparkSession
    found = Outcome(f"{out}/in_time", f"{out}/late", f"{out}/marks")
    spark.createDataFrame([], MARK).write.mode("overwrite").parquet(f"{found.marks}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        marks = spark.read.schema(MARK).option("recursiveFileLookup", "true").parquet(found.marks)
        latest = marks.where(F.col("batch_id") < batch_id).agg(F.max("latest")).first()[0]
        limit = F.lit(latest) - F.make_dt_interval(secs=F.lit(lateness_seconds))
        late = F.coalesce(F.col(at) < limit, F.col(at).isNull()) if latest is not None else F.lit(False)
        marked = batch.withColumn("__late", late).persist()
        try:
            marked.where(~F.col("__late")).drop("__late").write.mode("overwrite").parquet(f"{found.in_time}/batch_id={batch_id}")
            marked.where("__late").drop("__late").write.mode("overwrite").parquet(f"{found.late}/batch_id={batch_id}")
            line = marked.agg(
                F.lit(batch_id).cast("long").alias("batch_id"), F.max(at).alias("latest"), F.count(F.lit(1)).alias("n"),
                F.count_if("__late").alias("n_late"),
            )
            line.write.mode("overwrite").parquet(f"{found.marks}/batch={batch_id}")
        finally:
            marked.unpersist()

    query = (
        stream.writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return found


def marks(spark: SparkSession, found: Outcome) -> DataFrame:
    """(batch_id, latest, n, n_late): a line per micro-batch."""
    return spark.read.schema(MARK).option("recursiveFileLookup", "true").parquet(found.marks)
