"""Reproducible samples and splits: a row's fate depends on its id, and for exact splits on its rank in its class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bits of the hash that are compared with a share of 2 ** BITS; no remainder is taken, so no bucket is favoured.
BITS = 60
#: Leading bits by which an exact split counts before it ranks the rows at its edge alone.
COARSE_BITS = 16


def id_hash(id_column: str = "transaction_id", seed: int = 42) -> Column:
    """A number from 0 to 2 ** BITS - 1 by MD5, the same in every engine and for every partitioning."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def _below(fraction: float) -> int:
    return round(fraction * (1 << BITS))


def hash_sample(
    df: DataFrame, fraction: float = 0.20, id_column: str = "transaction_id", seed: int = 42
) -> DataFrame:
    return df.where(id_hash(id_column, seed) < _below(fraction))


def stratified_split(
    df: DataFrame,
    train: float = 0.80,
    id_column: str = "transaction_id",
    seed: int = 43,
) -> DataFrame:
    """Add ``split``: train or test.

    Hashes are independent of the label, so each class is divided in about the same proportion without sorting
    or gathering a class; ``exact_split`` meets the proportion to the row.
    """
    inside = id_hash(id_column, seed) < _below(train)
    return df.withColumn("split", F.when(inside, "train").otherwise("test"))


def split_edges(
    df: DataFrame, train: float = 0.80, label: str = "is_fraud", id_column: str = "transaction_id", seed: int = 43
) -> DataFrame:
    """(label, edge): per class the last (hash, id) that is trained on; null where none is.

    A class of n rows trains on ``round(train * n)`` of them. Rows are counted by the leading bits of their hash; the
    bucket in which the count is reached is the only one whose rows are ranked, about n / 65536 of a class.
    """
    keyed = df.select(F.col(label).alias("l"), id_hash(id_column, seed).alias("h"), F.col(id_column).alias("i"))
    coarse = F.shiftright("h", BITS - COARSE_BITS)
    by = Window.partitionBy("l")
    counted = (
        keyed.groupBy("l", coarse.alias("c")).agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(by.orderBy("c")))
        .withColumn("k", F.round(F.sum("n").over(by) * F.lit(train)).cast("long"))
    )
    at = counted.where((F.col("upto") >= F.col("k")) & (F.col("upto") - F.col("n") < F.col("k"))).select(
        F.col("l").alias("el"), F.col("c").alias("ec"), (F.col("k") - F.col("upto") + F.col("n")).alias("left")
    )
    near = keyed.withColumn("c", coarse).join(at, F.col("l").eqNullSafe(F.col("el")) & (F.col("c") == F.col("ec")))
    ranked = near.withColumn("rank", F.row_number().over(by.orderBy("h", "i"))).where(F.col("rank") <= F.col("left"))
    return ranked.groupBy(F.col("l").alias(label)).agg(F.max(F.struct("h", "i")).alias("edge"))


def exact_split(
    df: DataFrame, train: float = 0.80, label: str = "is_fraud", id_column: str = "transaction_id", seed: int = 43
) -> DataFrame:
    """Add ``split`` so that every class of n rows has ``round(train * n)`` training rows.

    Rows of one class that repeat an id fall on one side, so the count is off by their number at most. A null label is
    a class of its own; an empty table stays empty. The edges, one row a class, go to every task: dealt by the label, the
    table would lie in as many tasks as there are classes.
    """
    edges = F.broadcast(split_edges(df, train, label, id_column, seed).select(F.col(label).alias("__label"), "edge"))
    own = F.struct(id_hash(id_column, seed).alias("h"), F.col(id_column).alias("i"))
    inside = F.coalesce(own <= F.col("edge"), F.lit(False))
    return (
        df.join(edges, F.col(label).eqNullSafe(F.col("__label")), "left")
        .withColumn("split", F.when(inside, "train").otherwise("test"))
        .drop("__label", "edge")
    )


def split_counts(split: DataFrame, label: str = "is_fraud") -> DataFrame:
    return split.groupBy(label, "split").agg(F.count(F.lit(1)).alias("n"))
