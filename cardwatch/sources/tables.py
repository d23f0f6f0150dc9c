"""Raw tables and the transaction table that is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas

_SCHEMAS = {
    "events": schemas.EVENTS,
    "customer": schemas.CUSTOMER,
    "nation": schemas.NATION,
    "embeddings": schemas.EMBEDDINGS,
}

USERS_PER_CLIENT = 15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table with its declared schema, so a changed file type fails early."""
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock timestamp, whatever the session time zone."""
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def as_transactions(events: DataFrame, labelled: bool = True) -> DataFrame:
    """Turn event rows, batch or streaming, into transactions without any join.

    Unlabelled transactions lack the columns that come out of the JSON properties, so those
    are neither read nor parsed.
    """
    columns = [
        F.col("event_id").alias("transaction_id"),
        F.expr(f"user_id div {USERS_PER_CLIENT}").alias("client_id"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.col("ts").cast("date").alias("transaction_date"),
        F.hour("ts").alias("hour"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
    ]
    if not labelled:
        return events.select(*columns, "user_id")
    # A generator runs once per row; an expression would be parsed again by each of its users.
    parsed = events.select("*", F.json_tuple("props", "k").alias("k"))
    k = F.col("k").cast("int")
    fraud = F.when(k + (F.col("event_id") * 7919) % 31 < 30, 1).otherwise(0)
    return parsed.select(
        *columns,
        k.alias("merchant_id"),
        fraud.alias("is_fraud"),
        ((k.cast("double") - 50.0) / 10.0).alias("V14"),
        (
            ((F.col("event_id") * 104729) % 1000).cast("double") / 500.0
            - 1.0
            - fraud.cast("double")
        ).alias("V17"),
        "user_id",
    )


def transactions(
    spark: SparkSession,
    sf_dir: str,
    *,
    country: bool = False,
    pca: bool = False,
    labelled: bool = True,
) -> DataFrame:
    """One row per event. Joins and parsing are added only for columns that are asked for."""
    tx = as_transactions(read_table(spark, sf_dir, "events"), labelled)
    if country:
        customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = read_table(spark, sf_dir, "nation").select(
            "n_nationkey", F.col("n_name").alias("country")
        )
        # No hint: customers grow with the data, so the planner decides on measured size,
        # and adaptive execution splits a hot user when it has to be a shuffle join.
        home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        tx = tx.join(
            home.select("c_custkey", "country"), F.col("user_id") == F.col("c_custkey"), "left"
        ).drop("c_custkey")
    if pca:
        table = read_table(spark, sf_dir, "embeddings")
        vectors = (
            table.select(
                "vec_id",
                *[
                    (10.0 * F.element_at("embedding", i).cast("double")).alias(f"V{i}")
                    for i in (4, 11, 12)
                ],
            )
            .dropDuplicates(["vec_id"])
        )
        # This side grows with the data, so there is no hint: the planner goes by measured size.
        n = table.agg(F.count(F.lit(1))).scalar()
        tx = (
            tx.withColumn("_vector", F.try_mod("transaction_id", n))
            .join(vectors, F.col("_vector") == F.col("vec_id"), "left")
            .drop("vec_id", "_vector")
        )
    return tx.drop("user_id")
