"""Record validation, defaults, cleaning, null counts, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators.quantiles import approximate_quantiles, exact_quantiles

QUARTILES = {"q1": 0.25, "q3": 0.75}


def rules(columns: Sequence[str]) -> dict[str, Column]:
    """Rule name to a condition that is true where the rule is broken."""
    broken = {
        f"{c}_missing": F.col(c).isNull() if c in columns else F.lit(True)
        for c in schemas.REQUIRED
    }
    for name, c, low, low_open, high, high_open in schemas.RANGES:
        if c in columns:
            above = F.col(c) > low if low_open else F.col(c) >= low
            below = F.col(c) < high if high_open else F.col(c) <= high
            broken[name] = F.coalesce(~(above & below), F.lit(False))
    return broken


def validate(df: DataFrame) -> DataFrame:
    """Add ``violations``: the names of the rules each record breaks, in rule order."""
    names = [F.when(cond, F.lit(name)) for name, cond in rules(df.columns).items()]
    return df.withColumn("violations", F.array_compact(F.array(*names)))


def is_valid(columns: Sequence[str]) -> Column:
    """True where no rule is broken: a plain condition, without building the list of names."""
    broken = F.lit(False)
    for condition in rules(columns).values():
        broken = broken | condition
    return ~broken


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") > 0)


def route(ingested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rescued) of ingested requests: the clean and valid ones, and the others with their text and reasons.

    A faulty record has its fault as the one reason; a clean one that breaks rules has their names, and no text.
    """
    checked = validate(ingested)
    clean = F.col("fault").isNull()
    taken = checked.where(clean & (F.size("violations") == 0)).drop("violations", "fault", "body")
    reasons = F.when(clean, F.col("violations")).otherwise(F.array("fault"))
    rescued = checked.where(~clean | (F.size("violations") > 0)).select("transaction_id", "body", reasons.alias("reasons"))
    return taken, rescued


def rejects_by_rule(validated: DataFrame) -> DataFrame:
    return (
        validated.select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("n_rejected"))
    )


def apply_defaults(
    df: DataFrame, defaults: Mapping[str, float | str] = schemas.REQUEST_DEFAULTS
) -> DataFrame:
    """Fill absent optional fields, adding the column where it is missing altogether."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(value)) if c in df.columns else F.lit(value)
            for c, value in defaults.items()
        }
    )


def _or(*choices: Column) -> Column:
    """First choice that is neither null nor zero; the last one as it is."""
    *first, last = choices
    return F.coalesce(*[F.nullif(c, F.lit(0.0)) for c in first], last)


def resolve_features(df: DataFrame) -> DataFrame:
    """Model inputs of a request: computed values win unless they are absent or zero."""
    zero = F.lit(0.0)
    return df.withColumns(
        {
            "velocity_1h_calc": _or(F.col("velocity_1h_calc"), F.col("velocity_1h")),
            "zscore_amount_calc": _or(F.col("zscore_amount_calc"), F.col("zscore_amount"), zero),
            "risk_score": _or(F.col("risk_score"), F.lit(0.1)),
            **{c: F.coalesce(F.col(c), zero) for c in ("V4", "V11", "V12")},
        }
    )


def silver_clean(
    raw: DataFrame, required: Sequence[str], id_column: str = "transaction_id"
) -> DataFrame:
    """Clean bronze rows: complete, finite components, normalised country, one row per id.

    Of several deliveries of one id the earliest by timestamp stays, one without a time last; the choice is an
    aggregate, so copies of an id collapse before the shuffle.
    """
    components = [c for c in raw.columns if c[0] == "V" and c[1:].isdigit()]
    complete = raw.na.drop(subset=list(required))
    for c in components:
        x = F.col(c)
        complete = complete.where(x.isNull() | (F.abs(x) < float("inf")))
    tidy = complete.withColumn("country", F.upper(F.trim("country")))
    rest = [c for c in tidy.columns if c not in (id_column, "timestamp")]
    # A row without a time yields to any that has one.
    first = F.min(F.struct(F.isnull("timestamp").alias("_late"), "timestamp", *rest)).alias("first")
    return tidy.groupBy(id_column).agg(first).select(id_column, "first.*").select(*tidy.columns)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def quartiles(df: DataFrame, column: str = "amount", exact: bool = True) -> DataFrame:
    find = exact_quantiles if exact else approximate_quantiles
    return find(df, column, QUARTILES)


def iqr_bounds(df: DataFrame, column: str = "amount", exact: bool = True) -> Column:
    """Scalar subquery: a struct of q1, q3 and the fences 1.5 quartile distances outside."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return (
        quartiles(df, column, exact)
        .select(
            F.struct(
                "q1",
                "q3",
                (F.col("q1") - reach).alias("lower_bound"),
                (F.col("q3") + reach).alias("upper_bound"),
            )
        )
        .scalar()
    )


def outliers(df: DataFrame, column: str = "amount", exact: bool = True) -> DataFrame:
    """Rows outside the fences."""
    fences = iqr_bounds(df, column, exact)
    x = F.col(column)
    return df.where((x < fences["lower_bound"]) | (x > fences["upper_bound"]))


def outlier_report(df: DataFrame, column: str = "amount", exact: bool = True) -> DataFrame:
    """One row: the quartiles, the fences, and how many rows lie outside."""
    x = F.col(column)
    marked = df.select(x, iqr_bounds(df, column, exact).alias("b"))
    outside = (x < F.col("b.lower_bound")) | (x > F.col("b.upper_bound"))
    return (
        marked.agg(
            F.any_value("b").alias("b"),
            F.count_if(outside).alias("n_outliers"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .select("b.*", "n_outliers", "n_rows")
        .withColumn(
            "outlier_pct", F.coalesce(F.try_divide(F.col("n_outliers") * 100.0, "n_rows"), F.lit(0.0))
        )
    )
