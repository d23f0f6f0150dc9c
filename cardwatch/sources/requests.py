"""Scoring requests: JSON ingest and a synthetic mixture for load trials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas
from cardwatch.functions.display import padded_id


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of typed requests; lines that do not parse give rows of nulls to reject."""
    return spark.read.schema(schemas.REQUEST).option("mode", "PERMISSIVE").json(path)


def parse_requests(df: DataFrame, body: str) -> DataFrame:
    """Typed requests from a column of JSON text, such as the value of a message."""
    return df.select(F.from_json(body, schemas.REQUEST).alias("r")).select("r.*")


CORRUPT = "_corrupt"


def ingest(df: DataFrame, body: str = "value") -> DataFrame:
    """Typed requests of a column of JSON text, with ``body`` and ``fault`` for those that cannot be taken as they are.

    ``fault`` is null for a clean record; ``malformed`` for text that is no JSON object (an empty line and null too);
    ``wrong_type`` where a field does not have its declared type. Nothing is lost: the text of a faulty record stays in
    ``body``. Unknown fields are ignored.
    """
    schema = T.StructType([*schemas.REQUEST.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(F.col(body))).startswith("OBJECT"), F.lit(False))
    # A generator runs once per row; the filters behind would parse the text again for each field and rule they look at.
    once = F.struct(F.col(body).alias("__body"), F.from_json(body, schema, options).alias("r"), is_object.alias("__object"))
    parsed = df.select(F.inline(F.array(once)))
    fault = F.when(~F.col("__object"), "malformed").when(F.col(f"r.{CORRUPT}").isNotNull(), "wrong_type")
    return parsed.select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in schemas.REQUEST.fields],
        fault.alias("fault"),
        F.when(fault.isNotNull(), F.col("__body")).alias("body"),
    )


def ingest_files(spark: SparkSession, path: str) -> DataFrame:
    """``ingest`` of text files with one record a line."""
    return ingest(spark.read.text(path))


def encode_requests(df: DataFrame, body: str = "body") -> DataFrame:
    fields = [f.name for f in schemas.REQUEST.fields if f.name in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias(body))


def synthetic_mix(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Request rows of three kinds in the ratio 7 : 2 : 1.

    Ordinary rows, card-testing rows (small, fast, at night), and rows that repeat one id.
    """
    # Per column the uniform range of ordinary and of card-testing rows.
    ranges = {
        "amount": ((15.0, 200.0), (1.0, 50.0)),
        "velocity_1h": ((1.0, 3.0), (6.0, 15.0)),
        "night_tx_ratio": ((0.05, 0.20), (0.45, 0.75)),
        "V14": ((-0.5, 0.5), (-6.0, -3.0)),
        "V17": ((-0.5, 0.5), (-6.0, -3.0)),
    }

    def uniform(bounds: tuple[float, float], i: int) -> Column:
        low, high = bounds
        return F.lit(low) + F.rand(seed + i) * (high - low)

    draw = F.col("draw")
    kind = F.when(draw < 0.7, "legit").when(draw < 0.9, "card_testing").otherwise("repeat")
    rows = spark.range(n).withColumn("draw", F.rand(seed)).withColumn("kind", kind)
    columns = {
        name: F.when(F.col("kind") == "card_testing", uniform(fast, 2 * i + 1)).otherwise(
            uniform(usual, 2 * i + 2)
        )
        for i, (name, (usual, fast)) in enumerate(ranges.items())
    }
    identifier = F.when(F.col("kind") == "repeat", "TX-REPEAT").otherwise(padded_id(F.col("id")))
    return rows.withColumns({"transaction_id": identifier, **columns}).select(
        "transaction_id", "kind", *ranges
    )
