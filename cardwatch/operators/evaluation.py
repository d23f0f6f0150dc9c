"""Quality of a score against a binary label.

Everything starts from a histogram of the score: rows are counted per distinct score before
anything is ordered, and the running counts over it are blocked.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators.skew import running_totals, with_value_blocks


def score_histogram(
    df: DataFrame, score: str = "score", label: str = "is_fraud", digits: int | None = None
) -> DataFrame:
    """Positives and negatives per score; ``digits`` rounds the score, which merges thresholds."""
    value = F.col(score) if digits is None else F.round(score, digits)
    return df.groupBy(value.alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _ranked(df: DataFrame, score: str, label: str, digits: int | None) -> DataFrame:
    """The histogram with counts at or above each score and the class totals."""
    histogram = score_histogram(df, score, label, digits)
    blocked = with_value_blocks(histogram, "threshold").withColumn("one", F.lit(1))
    return (
        running_totals(blocked, "threshold", "block", ["pos", "neg", "one"], descending=True)
        .withColumn("tpr", F.try_divide(F.col("cum_pos").cast("double"), "all_pos"))
        .withColumn("fpr", F.try_divide(F.col("cum_neg").cast("double"), "all_neg"))
    )


def roc_curve(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    digits: int | None = None,
    corners_only: bool = False,
) -> DataFrame:
    """False and true positive rate at every score used as threshold.

    ``corners_only`` leaves out points at which neither count changes its step.
    """
    points = _ranked(df, score, label, digits)
    if corners_only:
        following = points.select(
            (F.col("cum_one") - 1).alias("_place"),
            F.col("pos").alias("_pos"),
            F.col("neg").alias("_neg"),
        )
        points = points.join(
            following, points["cum_one"] == following["_place"], "left"
        ).where(
            (F.col("cum_one") == 1)
            | F.col("_place").isNull()
            | (F.col("pos") != F.col("_pos"))
            | (F.col("neg") != F.col("_neg"))
        )
    return points.select("threshold", "fpr", "tpr")


def auc_roc(
    df: DataFrame, score: str = "score", label: str = "is_fraud", digits: int | None = None
) -> DataFrame:
    """Area under the ROC curve by trapezoids, so equal scores count half."""
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    return _ranked(df, score, label, digits).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc_roc")
    )


def calibrated_threshold(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    digits: int | None = None,
    recall: float = 0.90,
    corners_only: bool = False,
) -> DataFrame:
    """The highest threshold that reaches the recall, 0.5 where that is 1.0 or more."""
    curve = roc_curve(df, score, label, digits, corners_only)
    reached = F.when(F.col("tpr") >= recall, F.struct("threshold", "tpr", "fpr"))
    return (
        curve.agg(F.max(reached).alias("best"))
        .select("best.*")
        .withColumn(
            "threshold", F.when(F.col("threshold") >= 1.0, 0.5).otherwise(F.col("threshold"))
        )
    )


def confusion_matrix(
    df: DataFrame,
    threshold: float | Column,
    score: str = "score",
    label: str = "is_fraud",
) -> DataFrame:
    """One row: tn, fp, fn, tp of ``score >= threshold``."""
    cut = F.lit(threshold) if isinstance(threshold, float) else threshold
    flagged = df.select((F.col(score) >= cut).alias("hit"), (F.col(label) == 1).alias("true"))
    hit, true = F.col("hit"), F.col("true")
    return flagged.agg(
        F.count_if(~hit & ~true).alias("tn"),
        F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"),
        F.count_if(hit & true).alias("tp"),
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def metrics_of(matrix: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to a confusion matrix; an undefined ratio is 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return matrix.withColumns(
        {"precision": _rate(tp, tp + fp), "recall": _rate(tp, tp + fn)}
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def score_summary(
    df: DataFrame,
    score: str = "score",
    label: str = "is_fraud",
    digits: int | None = None,
    recall: float = 0.90,
) -> DataFrame:
    """One row from one pass over the ranked histogram: class totals, AUC, threshold, counts at both cuts.

    ``threshold`` is the calibrated one; ``tp`` and ``fp`` are counted at it, ``tp_half`` and ``fp_half`` at 0.5.
    """
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2))
    counts = ("cum_pos", "cum_neg")
    reached = F.when(F.col("tpr") >= recall, F.struct("threshold", *counts))
    # The lowest score of 0.5 or more has counted all of them.
    at_half = F.when(F.col("threshold") >= 0.5, F.struct((-F.col("threshold")).alias("t"), *counts))
    found = _ranked(df, score, label, digits).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc_roc"),
        F.max(reached).alias("best"), F.max(at_half).alias("half"),
    )
    high = F.col("best.threshold") >= 1.0
    half = [F.coalesce(F.col(f"half.{c}"), F.lit(0)) for c in counts]
    return found.select(
        "pos", "neg", "auc_roc",
        F.when(high, 0.5).otherwise(F.col("best.threshold")).alias("threshold"),
        *[
            F.when(high, h).otherwise(F.col(f"best.{c}")).alias(name)
            for name, c, h in zip(("tp", "fp"), counts, half)
        ],
        *[h.alias(name) for name, h in zip(("tp_half", "fp_half"), half)],
    )


def binary_metrics(
    df: DataFrame, score: str = "score", label: str = "is_fraud", digits: int | None = None
) -> DataFrame:
    """Precision, recall and F1 at 0.5 and at the calibrated threshold: two rows."""

    def line(cut: str, threshold: Column, tp: str, fp: str) -> Column:
        return F.struct(
            F.lit(cut).alias("cut"), threshold.alias("threshold"), F.col(tp).alias("tp"), F.col(fp).alias("fp"),
            (F.col("pos") - F.col(tp)).alias("fn"),
        )

    lines = F.array(
        line("default", F.lit(0.5), "tp_half", "fp_half"), line("calibrated", F.col("threshold"), "tp", "fp")
    )
    matrix = score_summary(df, score, label, digits).select(F.inline(lines))
    return metrics_of(matrix).select("cut", "threshold", "precision", "recall", "f1")


def classification_report(matrix: DataFrame) -> DataFrame:
    """Per class and averaged precision, recall, F1 and support, from a confusion matrix."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    classes = matrix.select(
        "*",
        _rate(tn, tn + fn).alias("p0"),
        _rate(tn, tn + fp).alias("r0"),
        _rate(tp, tp + fp).alias("p1"),
        _rate(tp, tp + fn).alias("r1"),
        (tn + fp).alias("s0"),
        (tp + fn).alias("s1"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})
    total = F.col("s0") + F.col("s1")

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            s.alias("support"),
        )

    def macro(x: str) -> Column:
        return (F.col(f"{x}0") + F.col(f"{x}1")) / 2

    def weighted(x: str) -> Column:
        both = F.col(f"{x}0") * F.col("s0") + F.col(f"{x}1") * F.col("s1")
        return F.coalesce(F.try_divide(both, total), F.lit(0.0))

    hits = _rate(tn + tp, total)
    lines = [
        line("Légitimes", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        line("Fraudes", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        line("accuracy", hits, hits, hits, total),
        line("macro avg", macro("p"), macro("r"), macro("f"), total),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    return classes.select(F.inline(F.array(*lines)))


def kpi_gate(
    metrics: DataFrame, targets: Mapping[str, float] = schemas.KPI_TARGETS
) -> DataFrame:
    """One row per target: the value reached and whether it exceeds the target."""
    lines = [
        F.struct(
            F.lit(name).alias("kpi"),
            F.col(name).alias("value"),
            F.lit(target).alias("target"),
            (F.col(name) > target).alias("pass"),
        )
        for name, target in targets.items()
    ]
    return metrics.select(F.inline(F.array(*lines)))


def score_metrics(
    df: DataFrame, score: str = "score", label: str = "is_fraud", digits: int | None = None
) -> DataFrame:
    """One row: precision, recall, F1 at the calibrated threshold, and the AUC."""
    summary = score_summary(df, score, label, digits).withColumn("fn", F.col("pos") - F.col("tp"))
    return metrics_of(summary).select("threshold", "precision", "recall", "f1", "auc_roc")


def probability_histogram(
    df: DataFrame, score: str = "fraud_probability", decision: str = "is_fraud", bins: int = 20
) -> DataFrame:
    """Rows per probability bin and decision, over equal bins of [0, 1]."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return (
        df.groupBy(place.alias("bin"), decision)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.col("bin") / F.lit(float(bins)))
    )
