"""Merchant enrichment, as-of lookup, label feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardwatch import schemas

DAY = 86_400


HINTED_ROWS = 100_000


def merchant_table(
    spark: SparkSession, rows: list[tuple[str, str, float]]
) -> DataFrame:
    """The merchant dimension, given inline."""
    return spark.createDataFrame(rows, schemas.MERCHANTS)


def enrich_merchants(df: DataFrame, merchants: DataFrame, hint: bool = False) -> DataFrame:
    """Left join on the merchant category; the hint holds for at most ``HINTED_ROWS`` counted merchants."""
    if hint and merchants.limit(HINTED_ROWS + 1).count() > HINTED_ROWS:
        hint = False
    side = F.broadcast(merchants) if hint else merchants
    return df.join(side, "merchant_category", "left")


def asof_lookup(
    df: DataFrame,
    history: DataFrame,
    on: str = "client_id",
    ts: str = "timestamp",
    valid_from: str = "valid_from",
    block_seconds: int = DAY,
) -> DataFrame:
    """Add the history columns that were valid for the key at the time of each row.

    Time is cut into blocks. Rows and entries, at most one a second, meet in their (key, block), where one pass in the
    order of time gives every row the entry before it; the last entry of earlier blocks stands in front. The work is
    linear in rows and entries, and a task holds no more than one block of a key at once. Entries without a time are never
    valid, and rows without one find none; a null key is a key of its own.
    """
    payload = [c for c in history.columns if c not in (on, valid_from)]
    entries = (
        history.where(F.col(valid_from).isNotNull())
        .groupBy(F.col(on).alias("_key"), F.col(valid_from).alias("_at"))
        .agg(F.max(F.struct(*payload)).alias("_entry"))
        .withColumn("_block", F.floor(F.col("_at") / block_seconds))
    )
    block = F.floor(F.col(ts) / block_seconds)
    asked = df.select(F.col(on).alias("_key"), block.alias("_block")).distinct()
    # One line per key and block: the entry that earlier blocks leave.
    last = (
        entries.groupBy("_key", "_block").agg(F.max_by("_entry", "_at").alias("_entry"))
        .unionByName(asked, allowMissingColumns=True)
        .groupBy("_key", "_block").agg(F.first("_entry", ignorenulls=True).alias("_entry"))
    )
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_key", "_block", F.last("_entry", ignorenulls=True).over(earlier).alias("_entry"))
    rows = df.select(
        F.col(on).alias("_key"), block.alias("_block"), F.col(ts).alias("_at"), F.struct(*df.columns).alias("_row")
    )
    together = rows.unionByName(entries, allowMissingColumns=True).unionByName(
        carried.where(F.col("_entry").isNotNull()), allowMissingColumns=True
    )
    # What is carried has no time and comes first; an entry is valid from its own second on.
    upto = (
        Window.partitionBy("_key", "_block")
        .orderBy(F.asc_nulls_first("_at"), F.col("_row").isNotNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        together.withColumn("_hit", F.last("_entry", ignorenulls=True).over(upto))
        .where(F.col("_row").isNotNull())
        .select("_row.*", *[F.col(f"_hit.{c}").alias(c) for c in payload])
    )


def relabel(df: DataFrame, feedback: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Replace labels by the latest operator feedback on the transaction, where there is any."""
    latest = feedback.groupBy("transaction_id").agg(
        F.max_by("true_label", "version").alias("true_label")
    )
    return df.join(latest, "transaction_id", "left").select(
        *[c for c in df.columns if c != label],
        F.coalesce(F.col("true_label").cast("int"), F.col(label)).alias(label),
        F.col("true_label").isNotNull().alias("relabelled"),
    )
