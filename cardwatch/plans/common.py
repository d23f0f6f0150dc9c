"""What the query modules share: rounding for comparison, the fixed model, common inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.sources import derived
from cardwatch.sources.tables import transactions

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6

# A linear model over the published inputs, in their order.
LINEAR_WEIGHTS = dict(
    zip(schemas.MODEL_FEATURES, [-0.6, -1.5, 0.05, 0.4, -0.002, 0.3, -0.2, 0.1], strict=True)
)
LINEAR_INTERCEPT = -1.0
LINEAR_THRESHOLD = 0.5
MODEL_VERSION = "p1-fraud-model/1"


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round for comparison; the first rounding takes off what the order of a sum leaves."""
    return df.withColumns({c: F.round(F.round(c, 10), digits) for c in columns})


def request_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.requests(transactions(spark, sf_dir))
