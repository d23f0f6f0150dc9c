"""Class, country and feature profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LABEL = "is_fraud"


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and percentage of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    # One row per class remains, so a window without keys sees a handful of rows.
    share = F.col("count") / F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(share * 100, 2)).orderBy(label)


#: (column, statistic, digits, name) of a profile's figures.
Figure = tuple[str, str, int, str]

_STATISTICS = {"mean": F.avg, "std": F.stddev}

# The published profiles.
COMPONENTS: list[Figure] = [
    ("V14", "mean", 3, "V14_moy"),
    ("V17", "mean", 3, "V17_moy"),
    ("V1", "mean", 3, "V1_moy"),
    ("V3", "mean", 3, "V3_moy"),
    ("V14", "std", 3, "V14_std"),
]
BEHAVIOUR: list[Figure] = [
    ("velocity_1h", "mean", 2, "vel_1h_moy"),
    ("velocity_10min", "mean", 2, "vel_10min_moy"),
    ("night_tx_ratio", "mean", 3, "night_ratio"),
    ("amount", "mean", 2, "montant_moy"),
    ("amount", "std", 2, "montant_std"),
]


def class_profile(df: DataFrame, figures: Sequence[Figure], label: str = LABEL) -> DataFrame:
    """One row per class with the figures whose columns the table has."""
    found = [
        F.round(_STATISTICS[statistic](column), digits).alias(name)
        for column, statistic, digits, name in figures
        if column in df.columns
    ]
    classes = df.groupBy(label)
    return (classes.agg(*found) if found else df.select(label).distinct()).orderBy(label)


def vfeature_profile(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class means of the components that tell the classes apart, and the spread of V14."""
    return class_profile(df, COMPONENTS, label)


def behaviour_profile(
    df: DataFrame,
    label: str = LABEL,
    velocity_1h: str = "velocity_1h",
    velocity_10min: str = "velocity_10min",
) -> DataFrame:
    """Class means of speed, night share and amount; the speeds may go by other names."""
    named = {"velocity_1h": velocity_1h, "velocity_10min": velocity_10min}
    return class_profile(df, [(named.get(c, c), *rest) for c, *rest in BEHAVIOUR], label)


def feature_means(
    df: DataFrame, features: Sequence[str], label: str = LABEL, digits: int = 3
) -> DataFrame:
    """Class means of those of the given features that the table has."""
    return class_profile(df, [(c, "mean", digits, c) for c in features], label)


def country_pivot(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Legit and fraud counts per country with the fraud rate, highest rate first.

    A country without one of the classes has no rate.
    """
    total = F.col("legit") + F.col("fraude")
    return (
        df.groupBy("country")
        .pivot(label, [0, 1])
        .count()
        .withColumnsRenamed({"0": "legit", "1": "fraude"})
        .withColumn("taux_fraude", F.round(F.col("fraude") / total * 100, 1))
        .orderBy(F.desc_nulls_last("taux_fraude"), "country")
    )


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: fraud rate, negatives per positive, balanced weight of each class."""
    n = F.count(label)
    positive = F.count_if(F.col(label) == 1)
    negative = F.count_if(F.col(label) == 0)
    return df.agg(n.alias("n"), positive.alias("n_pos"), negative.alias("n_neg")).select(
        "n",
        F.try_divide(F.col("n_pos").cast("double"), "n").alias("fraud_rate"),
        F.try_divide(F.col("n_neg").cast("double"), "n_pos").alias("scale_pos_weight"),
        F.try_divide(F.col("n").cast("double"), 2 * F.col("n_pos")).alias("weight_pos"),
        F.try_divide(F.col("n").cast("double"), 2 * F.col("n_neg")).alias("weight_neg"),
    )


def with_class_weight(
    df: DataFrame, label: str = LABEL, alias: str = "class_weight", balanced: bool = True
) -> DataFrame:
    """Add the weight that evens out the classes; not balanced: positives count for the ratio."""
    weights = class_weights(df, label).select(
        F.struct("weight_pos", "weight_neg", "scale_pos_weight")
    ).scalar()
    if balanced:
        weight = F.when(F.col(label) == 1, weights["weight_pos"]).otherwise(weights["weight_neg"])
    else:
        weight = F.when(F.col(label) == 1, weights["scale_pos_weight"]).otherwise(1.0)
    return df.withColumn(alias, weight)
