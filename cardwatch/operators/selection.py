"""Feature selection on the full table: variance filter and ANOVA F ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas


def numeric_features(df: DataFrame, exclude: Sequence[str] = schemas.NON_FEATURES) -> list[str]:
    """Numeric columns that are not identifiers, keys, time or label."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def variance_filter(
    df: DataFrame, features: Sequence[str] | None = None, threshold: float = 0.01
) -> DataFrame:
    """Population variance per feature, and whether it exceeds the threshold. One pass."""
    features = features or numeric_features(df)
    spread = df.agg(*[F.var_pop(c).alias(c) for c in features])
    lines = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("variance")) for c in features]
    return spread.select(F.inline(F.array(*lines))).withColumn(
        "kept", F.coalesce(F.col("variance") > threshold, F.lit(False))
    )


def _class_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Count, mean and squared deviations per feature and class: one aggregate over the table, one row a class.

    The features become rows only behind it.
    """
    value = lambda c: F.col(c).cast("double")
    by_class = df.groupBy(label).agg(
        *[F.struct(F.count(value(c)).alias("n"), F.avg(value(c)).alias("mean"), F.var_pop(value(c)).alias("v")).alias(c) for c in features]
    )
    lines = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("of")) for c in features]
    return (
        by_class.select(F.col(label).alias("__label"), F.inline(F.array(*lines)))
        .where("of.n > 0")
        .select(
            "feature",
            F.col("__label").isNotNull().alias("labelled"),
            F.col("of.n").alias("n"),
            F.col("of.mean").alias("mean"),
            (F.col("of.v") * F.col("of.n")).alias("m2"),
        )
    )


def feature_scores(
    df: DataFrame, features: Sequence[str] | None = None, label: str = "is_fraud"
) -> DataFrame:
    """Population variance and ANOVA F of each feature between the classes.

    Both follow from the moments per class, so the table is read once for all features. Rows
    without a label count for the variance only.
    """
    moments = _class_moments(df, features or numeric_features(df), label)
    whole, known = Window.partitionBy("feature"), Window.partitionBy("feature", "labelled")

    def away(window: Window) -> Column:
        centre = F.sum(F.col("n") * F.col("mean")).over(window) / F.sum("n").over(window)
        return F.col("n") * F.pow(F.col("mean") - centre, F.lit(2))

    spread = moments.select("*", away(whole).alias("around_all"), away(known).alias("around"))
    of_classes = F.col("labelled")

    def labelled_sum(column: str) -> Column:
        return F.sum(F.when(of_classes, F.col(column)))

    return (
        spread.groupBy("feature")
        .agg(
            (F.sum(F.col("m2") + F.col("around_all")) / F.sum("n")).alias("variance"),
            F.count_if(of_classes).alias("classes"),
            labelled_sum("n").alias("n"),
            labelled_sum("around").alias("between"),
            labelled_sum("m2").alias("within"),
        )
        .select(
            "feature",
            "variance",
            F.try_divide(
                F.try_divide("between", F.col("classes") - 1),
                F.try_divide("within", F.col("n") - F.col("classes")),
            ).alias("f_score"),
        )
    )


def anova_topk(
    df: DataFrame,
    k: int = 20,
    features: Sequence[str] | None = None,
    label: str = "is_fraud",
    threshold: float = 0.01,
) -> DataFrame:
    """The k features of highest F among those that pass the variance filter."""
    kept = feature_scores(df, features, label).where(F.col("variance") > threshold)
    best = kept.orderBy(F.desc_nulls_last("f_score"), "feature").limit(k)
    return best.select("feature", "f_score")


def select_top_features(
    df: DataFrame, target: str = "is_fraud", k: int = 20, threshold: float = 0.01
) -> list[str]:
    """Names of the best features, best first; only these names reach the driver."""
    features = [c for c in numeric_features(df) if c != target]
    best = anova_topk(df, k, features, target, threshold)
    return [row["feature"] for row in best.collect()]
