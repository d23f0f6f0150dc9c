"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.functions.display import risk_level
from cardwatch.operators import (
    evaluation,
    gold,
    incremental,
    joins,
    monitoring,
    profiles,
    quality,
    reuse,
    sampling,
    scoring,
    selection,
    sketches,
    trailing,
)
from cardwatch.plans.common import (
    DIGITS,
    LINEAR_INTERCEPT,
    LINEAR_THRESHOLD,
    LINEAR_WEIGHTS,
    MODEL_VERSION,
    Query,
    request_table,
    rounded,
)
from cardwatch.session import scratch_path
from cardwatch.sources import derived, lake, layout, requests
from cardwatch.sources.tables import as_transactions, read_table, transactions

PROBE_DAY = "2024-01-15"
#: For the given tables; one bucket should fit one task.
LAYOUT_BUCKETS = 32
FEATURES = [
    "amount",
    "V14",
    "V17",
    "V4",
    "V11",
    "V12",
    "night_tx_ratio",
    "velocity_1h_calc",
    "velocity_10min_calc",
    "avg_amount_7d_calc",
    "zscore_amount_calc",
    "risk_score",
]

def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(
        "transaction_id", "is_fraud", (-F.col("V17")).alias("score")
    )


def _gold(spark: SparkSession, sf_dir: str, **dims: bool) -> DataFrame:
    return gold.compute_features(transactions(spark, sf_dir, **dims))


# Sources, sinks, projections, filters


def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, country=True, pca=True)
    return rounded(tx, "V14", "V17", "V4", "V11", "V12").drop("hour", "merchant_id")


def daily_slice_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lake.day_range(read_table(spark, sf_dir, "events"), "ts", PROBE_DAY)
    return day.agg(F.count(F.lit(1)).alias("n"))


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the gold table by date once, then count and validate what was written."""
    path = scratch_path(spark, "gold")
    lake.write_by_date(_gold(spark, sf_dir), path)
    written = lake.read_lake(spark, path)
    return (
        written.groupBy("transaction_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("velocity_1h_calc").alias("sum_velocity_1h"),
            F.round(F.sum("risk_score"), DIGITS).alias("sum_risk"),
        )
    )


def gold_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the partitioned gold table: the scan reads that day's folder only."""
    path = scratch_path(spark, "gold")
    lake.write_by_date(_gold(spark, sf_dir), path)
    day = lake.day_slice(lake.read_lake(spark, path), PROBE_DAY)
    return day.select("transaction_id", "client_id", "velocity_1h_calc", "risk_score")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table brought up to date after a late delivery for one day; the days before it are not read again."""
    tx = transactions(spark, sf_dir)
    bronze, made = scratch_path(spark, "bronze"), scratch_path(spark, "gold")
    late = (F.col(lake.PARTITION) == F.to_date(F.lit(PROBE_DAY))) & (F.col("transaction_id") % 2 == 0)
    lake.append_by_date(tx.where(~late), bronze)
    lake.write_by_date(gold.compute_features(lake.read_lake(spark, bronze)), made)
    delivery = tx.where(late)
    lake.append_by_date(delivery, bronze)
    incremental.rebuild(lake.read_lake(spark, bronze), made, incremental.changed_days(delivery))
    return _gold_rows(lake.read_lake(spark, made))


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended deliveries of raw rows, counted per day."""
    path = scratch_path(spark, "bronze")
    raw = transactions(spark, sf_dir)
    for _ in range(2):
        lake.append_by_date(raw, path)
    return lake.read_lake(spark, path).groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("transaction_id").alias("n_ids")
    )


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.table_shape(read_table(spark, sf_dir, "events"))


def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return tx.select("transaction_id", "client_id", "amount", "is_fraud").orderBy(
        "transaction_id"
    ).limit(3)


def project_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        transactions(spark, sf_dir).select("transaction_id", "is_fraud", "V14", "V17", "amount"),
        "V14",
        "V17",
    )


def positive_amount_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, labelled=False)
    return tx.where(F.col("amount") > 0).agg(F.count(F.lit(1)).alias("n"))


def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.outlier_report(transactions(spark, sf_dir, labelled=False))
    return rounded(report, "q1", "q3", "lower_bound", "upper_bound", "outlier_pct")


def amount_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.quartiles(transactions(spark, sf_dir, labelled=False)), "q1", "q3")


def amount_quartiles_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the sketch's quartiles have ranks within one hundredth of the exact ones."""
    tx = transactions(spark, sf_dir, labelled=False)
    found = quality.quartiles(tx, exact=False).select(F.struct("q1", "q3")).scalar()

    def near(q: str, share: float):
        below = F.avg((F.col("amount") < found[q]).cast("double"))
        upto = F.avg((F.col("amount") <= found[q]).cast("double"))
        return (below <= share + 0.01) & (upto >= share - 0.01)

    return tx.where(F.col("amount").isNotNull()).agg(
        near("q1", 0.25).alias("q1_within_one_percent"), near("q3", 0.75).alias("q3_within_one_percent")
    )


def validate_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quality.validate(request_table(spark, sf_dir))
    return checked.select(
        "transaction_id",
        F.array_join("violations", ",").alias("violations"),
        (F.size("violations") == 0).alias("valid"),
    )


def rejects_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejects_by_rule(quality.validate(request_table(spark, sf_dir)))


def apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = quality.apply_defaults(request_table(spark, sf_dir))
    return rounded(
        filled.select("transaction_id", *schemas.REQUEST_DEFAULTS),
        *[c for c in schemas.REQUEST_DEFAULTS if c != "merchant_category"],
    )


def resolve_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = quality.resolve_features(quality.apply_defaults(request_table(spark, sf_dir)))
    names = ["velocity_1h_calc", "zscore_amount_calc", "risk_score", "V4", "V11", "V12"]
    return rounded(resolved.select("transaction_id", *names), *names)


def decode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests written as JSON text and read back with the declared schema."""
    bodies = requests.encode_requests(request_table(spark, sf_dir))
    parsed = requests.parse_requests(bodies, "body")
    return rounded(
        parsed.select("transaction_id", "amount", "velocity_1h", "V14", "merchant_category"),
        "V14",
    )


def ingest_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests from files of JSON lines, some of them broken: accepted and rescued ones by reason."""
    bodies = requests.encode_requests(request_table(spark, sf_dir))
    number = F.get_json_object("body", "$.transaction_id").cast("long")
    broken = (
        F.when(number % 19 == 0, F.substring("body", 1, 20))
        .when(number % 23 == 0, F.regexp_replace("body", '"amount":[^,}]*', '"amount":"high"'))
        .otherwise(F.col("body"))
    )
    path = scratch_path(spark, "requests")
    bodies.select(broken.alias("value")).write.text(path)
    taken, rescued = quality.route(requests.ingest_files(spark, path))
    return (
        taken.select(F.lit("accepted").alias("reason"))
        .unionByName(rescued.select(F.explode("reasons").alias("reason")))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    )


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(transactions(spark, sf_dir)).select("transaction_id", "is_fraud")


def stratified_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_counts(sampling.stratified_split(transactions(spark, sf_dir)))


def stratified_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = sampling.exact_split(transactions(spark, sf_dir))
    return split.select("transaction_id", "is_fraud", "split")


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derived.raw_feed(transactions(spark, sf_dir, country=True))
    clean = quality.silver_clean(
        raw, ["transaction_id", "transaction_date", "amount", "country", "V14", "V17", "is_fraud"]
    )
    return clean.select("transaction_id", "timestamp", "amount", "country", "is_fraud")


# Joins


def _merchant_join(hint: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        merchants = joins.merchant_table(spark, derived.MERCHANT_ROWS)
        tx = transactions(spark, sf_dir, labelled=False).select("transaction_id", "merchant_category", "amount")
        return joins.enrich_merchants(tx, merchants, hint)

    return query


def _bucketed(spark: SparkSession, df: DataFrame, order: str) -> DataFrame:
    """``df`` read back from a new table that is laid out by client."""
    path = scratch_path(spark, "bucketed")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    layout.write_bucketed(df, table, path, order=order, buckets=LAYOUT_BUCKETS)
    return layout.read_bucketed(spark, table)


def gold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold features of a table laid out by client: no exchange after the write."""
    return _gold_rows(gold.compute_features(_bucketed(spark, transactions(spark, sf_dir), "timestamp")))


def asof_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of lookup between two tables laid out by client."""
    tx = transactions(spark, sf_dir, labelled=False)
    history = _bucketed(spark, derived.feature_snapshots(tx), "valid_from")
    rows = _bucketed(spark, tx.select("transaction_id", "client_id", "timestamp"), "timestamp")
    return rounded(joins.asof_lookup(rows, history), "avg_amount_day")


def feature_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, labelled=False)
    found = joins.asof_lookup(
        tx.select("transaction_id", "client_id", "timestamp"), derived.feature_snapshots(tx)
    )
    return rounded(found, "avg_amount_day")


def feedback_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return joins.relabel(tx.select("transaction_id", "is_fraud"), derived.feedback(tx))


# Profiles


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.class_distribution(transactions(spark, sf_dir))


def vfeature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.vfeature_profile(transactions(spark, sf_dir))


def behaviour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.behaviour_profile(
        _gold(spark, sf_dir), "is_fraud", "velocity_1h_calc", "velocity_10min_calc"
    )


def feature_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.feature_means(_gold(spark, sf_dir, pca=True), [*FEATURES, "gps_lat"])


def country_fraud_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.country_pivot(transactions(spark, sf_dir, country=True))


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_fraud_pivot(spark, sf_dir).limit(12)


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(
        request_table(spark, sf_dir),
        ["amount", "V14", "V17", "zscore_amount", "velocity_1h_calc", "merchant_category"],
    )


def gold_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.validate_features(_gold(spark, sf_dir))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        profiles.class_weights(transactions(spark, sf_dir)),
        "fraud_rate",
        "scale_pos_weight",
        "weight_pos",
        "weight_neg",
    )


def class_weight_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).select("transaction_id", "is_fraud")
    both = profiles.with_class_weight(
        profiles.with_class_weight(tx), alias="positive_weight", balanced=False
    )
    return rounded(both, "class_weight", "positive_weight")


# Windows


def _velocity(spec: trailing.Trailing) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tx = transactions(spark, sf_dir, labelled=False).select("transaction_id", "client_id", "timestamp")
        return gold.velocity(tx, spec)

    return query


def avg_amount_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, labelled=False).select("transaction_id", "client_id", "timestamp", "amount")
    return rounded(
        trailing.trailing(tx, [gold.AVG_AMOUNT_7D]).select("transaction_id", "avg_amount_7d_calc"),
        "avg_amount_7d_calc",
    )


def zscore_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, labelled=False).select("transaction_id", "client_id", "timestamp", "amount")
    return rounded(
        gold.amount_zscore(tx).select("transaction_id", "zscore_amount_calc"),
        "zscore_amount_calc",
    )


def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir).select("transaction_id", "risk_score")


GOLD_COLUMNS = [
    "transaction_id",
    "client_id",
    "transaction_date",
    "is_fraud",
    "velocity_1h_calc",
    "velocity_10min_calc",
    "avg_amount_7d_calc",
    "zscore_amount_calc",
    "night_tx_ratio",
    "risk_score",
]


def _gold_rows(features: DataFrame) -> DataFrame:
    return rounded(
        features.select(*GOLD_COLUMNS),
        "avg_amount_7d_calc",
        "zscore_amount_calc",
        "night_tx_ratio",
    )


def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_rows(_gold(spark, sf_dir))


def gold_features_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features with a third of all rows on one client."""
    return _gold_rows(gold.compute_features(_one_hot_client(transactions(spark, sf_dir))))


def _one_hot_client(tx: DataFrame) -> DataFrame:
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("client_id"))
    return tx.withColumn("client_id", hot)


def night_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        gold.night_ratio(transactions(spark, sf_dir, labelled=False)).select("transaction_id", "night_tx_ratio"),
        "night_tx_ratio",
    )


def distinct_daily_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct merchants of a client over seven calendar days, from merged daily sketches."""
    daily = sketches.daily_distinct(transactions(spark, sf_dir), "merchant_id")
    return sketches.trailing_distinct(daily, 7).withColumnRenamed("distinct_values", "distinct_merchants_7d")


def latency_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency percentiles of every day from daily sketches, held against the rows: rank errors below 1 %."""
    log, points = _log(spark, sf_dir), {"p50": 0.50, "p95": 0.95}
    daily = sketches.daily_percentiles(log, "latency_ms")
    errors = sketches.rank_errors(log, "latency_ms", sketches.percentiles(daily, points, "day"), points)
    whole = sketches.percentiles(daily.withColumn("all", F.lit(0)), points, "all").withColumn("day", F.col("all").cast("long"))
    every = sketches.rank_errors(log.withColumn("timestamp", F.lit(0).cast("long")), "latency_ms", whole.drop("all", "n"), points)
    return errors.select(F.col("day").cast("string").alias("day"), "n", (F.col("p50") < 0.01).alias("p50_ok"), (F.col("p95") < 0.01).alias("p95_ok")).unionByName(
        every.select(F.lit("all").alias("day"), "n", (F.col("p50") < 0.01).alias("p50_ok"), (F.col("p95") < 0.01).alias("p95_ok"))
    )


DISTINCT_SPECS = [
    ("distinct_merchants_7d", "merchant_id", gold.DAYS_7),
    ("distinct_countries_30d", "country", gold.DAYS_30),
]


def _distinct(one_hot: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tx = transactions(spark, sf_dir, country=True).select(
            "transaction_id", "client_id", "timestamp", "merchant_id", "country"
        )
        counted = trailing.trailing_distinct(_one_hot_client(tx) if one_hot else tx, DISTINCT_SPECS)
        return counted.select("transaction_id", *[spec[0] for spec in DISTINCT_SPECS])

    return query


def _running(one_hot: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tx = transactions(spark, sf_dir, labelled=False).select(
            "transaction_id", "client_id", "timestamp", "amount"
        )
        scored = trailing.running_zscore(_one_hot_client(tx) if one_hot else tx)
        return rounded(scored.select("transaction_id", "zscore_running"), "zscore_running")

    return query


def trailing_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, labelled=False).select("transaction_id", "client_id", "timestamp", "amount")
    return rounded(
        trailing.trailing(tx, [gold.TX_COUNT_7D, gold.AVG_AMOUNT_30D]).select(
            "transaction_id", "tx_count_7d", "avg_amount_30d"
        ),
        "avg_amount_30d",
    )


def ttl_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are not repeats, within an hour, of the same user and type."""
    events = as_transactions(read_table(spark, sf_dir, "events"), labelled=False).select(
        "transaction_id", "user_id", "merchant_category", "timestamp"
    )
    return reuse.ttl_dedup(events, ["user_id", "merchant_category"])


# Evaluation


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_scored(spark, sf_dir), 0.2)


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        evaluation.binary_metrics(_scored(spark, sf_dir)), "threshold", "precision", "recall", "f1"
    )


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        evaluation.classification_report(confusion_matrix(spark, sf_dir)),
        "precision",
        "recall",
        "f1",
    )


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.roc_curve(_scored(spark, sf_dir)), "threshold", "fpr", "tpr")


def roc_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = evaluation.roc_curve(_scored(spark, sf_dir), corners_only=True)
    return rounded(curve, "threshold", "fpr", "tpr")


def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.auc_roc(_scored(spark, sf_dir)), "auc_roc")


def calibrated_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        evaluation.calibrated_threshold(_scored(spark, sf_dir)), "threshold", "tpr", "fpr"
    )


def kpi_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = evaluation.kpi_gate(evaluation.score_metrics(_scored(spark, sf_dir)))
    return rounded(gate, "value")


# Monitoring


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.prediction_log(transactions(spark, sf_dir))


def prediction_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.prediction_stats(_log(spark, sf_dir))


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.metric_rows(prediction_stats(spark, sf_dir))


def probability_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.probability_histogram(_log(spark, sf_dir))


def recent_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = monitoring.recent_predictions(_log(spark, sf_dir))
    return recent.select(
        "transaction_id", "timestamp", "fraud_probability", "is_fraud", "latency_ms"
    )


def display_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir).withColumns(
        {
            "transaction_id": 1_000_000_000_000 + F.col("transaction_id"),
            "risk_level": risk_level(F.col("fraud_probability")),
        }
    )
    return monitoring.display_rows(log)


def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        monitoring.latency_summary(_log(spark, sf_dir)),
        "p50_ms",
        "p95_ms",
        "requests_per_s",
        "failure_rate",
    )


def risk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select(
        "transaction_id", risk_level(F.col("fraud_probability")).alias("risk_level")
    )


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_batch(
        request_table(spark, sf_dir),
        scoring.linear_model(LINEAR_WEIGHTS, LINEAR_INTERCEPT),
        LINEAR_THRESHOLD,
        MODEL_VERSION,
    )


# Selection


def variance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        selection.variance_filter(_gold(spark, sf_dir, pca=True), FEATURES), "variance"
    )


def anova_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        selection.anova_topk(_gold(spark, sf_dir, pca=True), 8, FEATURES), "f_score", digits=4
    )


BATCH: dict[str, Query] = {
    "scan_transactions": scan_transactions,
    "daily_slice_count": daily_slice_count,
    "gold_roundtrip": gold_roundtrip,
    "gold_day_slice": gold_day_slice,
    "bronze_append": bronze_append,
    "table_shape": table_shape,
    "table_preview": table_preview,
    "project_core": project_core,
    "positive_amount_count": positive_amount_count,
    "iqr_outliers": iqr_outliers,
    "amount_quartiles": amount_quartiles,
    "amount_quartiles_approx": amount_quartiles_approx,
    "validate_transactions": validate_transactions,
    "rejects_by_rule": rejects_by_rule,
    "apply_defaults": apply_defaults,
    "resolve_features": resolve_features,
    "decode_requests": decode_requests,
    "ingest_requests": ingest_requests,
    "gold_incremental": gold_incremental,
    "distinct_daily_sketch": distinct_daily_sketch,
    "latency_rollup": latency_rollup,
    "hash_sample": hash_sample,
    "stratified_split_counts": stratified_split_counts,
    "stratified_split_exact": stratified_split_exact,
    "silver_clean": silver_clean,
    "merchant_enrich": _merchant_join(hint=False),
    "merchant_enrich_broadcast": _merchant_join(hint=True),
    "feature_asof": feature_asof,
    "gold_bucketed": gold_bucketed,
    "asof_bucketed": asof_bucketed,
    "feedback_relabel": feedback_relabel,
    "class_distribution": class_distribution,
    "vfeature_profile": vfeature_profile,
    "behaviour_profile": behaviour_profile,
    "feature_means": feature_means,
    "country_fraud_pivot": country_fraud_pivot,
    "top_countries": top_countries,
    "null_counts": null_counts,
    "gold_validation": gold_validation,
    "class_weights": class_weights,
    "class_weight_column": class_weight_column,
    "velocity_1h": _velocity(gold.VELOCITY_1H),
    "velocity_10min": _velocity(gold.VELOCITY_10MIN),
    "avg_amount_7d": avg_amount_7d,
    "zscore_amount": zscore_amount,
    "risk_score": risk_score,
    "gold_features": gold_features,
    "gold_features_hot": gold_features_hot,
    "night_ratio": night_ratio,
    "distinct_trailing": _distinct(False),
    "distinct_trailing_hot": _distinct(True),
    "zscore_running": _running(False),
    "zscore_running_hot": _running(True),
    "trailing_volume": trailing_volume,
    "ttl_dedup": ttl_dedup,
    "confusion_matrix": confusion_matrix,
    "binary_metrics": binary_metrics,
    "classification_report": classification_report,
    "roc_curve": roc_curve,
    "roc_corners": roc_corners,
    "auc_roc": auc_roc,
    "calibrated_threshold": calibrated_threshold,
    "kpi_gate": kpi_gate,
    "prediction_stats": prediction_stats,
    "metric_rows": metric_rows,
    "probability_histogram": probability_histogram,
    "recent_predictions": recent_predictions,
    "display_rows": display_rows,
    "latency_summary": latency_summary,
    "risk_level": risk_levels,
    "score_batch": score_batch,
    "variance_filter": variance_filter,
    "anova_topk": anova_topk,
}
