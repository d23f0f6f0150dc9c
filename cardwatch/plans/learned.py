"""Queries that fit models. Fits are not SQL, so most are checked by rows and unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.ml import boosting, isolation, registry, training
from cardwatch.operators import evaluation, gold, scoring
from cardwatch.plans.common import MODEL_VERSION, Query, request_table, rounded
from cardwatch.session import scratch_path
from cardwatch.sources.tables import transactions

MODEL_NAME = "p1-fraud-model"
#: The AUC that every model must exceed.
AUC_FLOOR = 0.9

# Scores that need no fit, in the order in which ties are resolved.
PLAIN_SCORES = {"v17": "-V17", "v14": "-V14", "both": "-(V14 + V17)"}


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and features of the gold table, written once: split, fits and scores read it many times."""
    path = scratch_path(spark, "gold")
    rows = gold.compute_features(transactions(spark, sf_dir, pca=True))
    wanted = ["transaction_id", training.LABEL, *training.available_features(rows, schemas.MODEL_FEATURES)]
    rows = rows.select(*wanted)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three models on the whole gold table: sizes of the split, and whether they pass the floor."""
    runs = training.compare_models(_gold(spark, sf_dir)).runs
    return runs.select(
        "run_name",
        "seq",
        *[F.col("params")[c].cast("long").alias(c) for c in ("train_size", "test_size", "n_features")],
        (F.col("metrics")["auc_roc"] > AUC_FLOOR).alias("above_floor"),
    )


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC, F1, precision and recall of all three models on the test rows of the whole gold table."""
    runs = training.compare_models(_gold(spark, sf_dir)).runs
    return runs.select(
        "run_name", "seq", *[F.col("metrics")[c].alias(c) for c in ("auc_roc", "f1", "precision", "recall")]
    )


def _linear(table: DataFrame) -> training.Comparison:
    return training.compare_models(table, only=("LR",))


def model_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importance of every feature in each of the three models."""
    models = training.compare_models(_gold(spark, sf_dir)).models
    rows = None
    for name, model in models.items():
        own = training.feature_importance(model, spark).withColumn("run_name", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    return rows.select("run_name", "feature", "importance")


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of all three models, checked as a table: names, signs, and the sum for trees."""
    rows = model_importances(spark, sf_dir)
    total = F.round(F.sum("importance"), 6)
    return rows.groupBy("run_name").agg(
        F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("features"),
        (F.min("importance") >= 0).alias("non_negative"),
        F.when(F.col("run_name") != "LR", total).alias("total"),
    )


def promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the plain scores one after another; each that beats production becomes a version."""
    path = scratch_path(spark, "runs")
    plain_runs(spark, sf_dir).write.parquet(path)
    runs = spark.read.parquet(path)
    versions = registry.no_versions(spark)
    for name in PLAIN_SCORES:
        versions = registry.promote_if_better(versions, runs, MODEL_NAME, f"run-{name}", f"plain/{name}")
    return versions.select("name", "version", "stage", "run_id")


def training_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, pick, calibrate, report, gate, promote, save, load and score with the saved threshold.

    One row: sizes of the split, the lines of report and gate, whether the recall is reached and the saved model
    decides as the fitted one does.
    """
    rows = _gold(spark, sf_dir)
    chosen = training.choose(rows)
    path = scratch_path(spark, "model")
    registry.save_model(chosen.model, path, schemas.MODEL_FEATURES, chosen.threshold)
    best = training.latest_run(chosen.runs).first()["run_id"]
    versions = registry.promote_if_better(registry.no_versions(spark), chosen.runs, MODEL_NAME, best, path)
    live = registry.in_production(versions, MODEL_NAME).first()
    model, _, threshold = registry.load_model(spark, live["path"])
    table = training.training_table(rows, schemas.MODEL_FEATURES)
    again = training.scored(model, table.where("split = 'test'"))
    matrix = evaluation.confusion_matrix(again, threshold)
    report = evaluation.classification_report(matrix)
    gate = evaluation.kpi_gate(evaluation.score_metrics(again))
    fitted = chosen.scores.select("transaction_id", (F.col("score") >= chosen.threshold).alias("fitted"))
    agreed = (
        again.join(fitted, "transaction_id")
        .agg(F.count(F.lit(1)).alias("n_test"), F.count_if((F.col("score") >= threshold) != F.col("fitted")).alias("n_changed"))
    )
    reached = report.where("class = 'Fraudes'").select((F.col("recall") >= 0.9).alias("recall_reached"))
    return agreed.select(
        table.where("split = 'train'").agg(F.count(F.lit(1))).scalar().alias("n_train"),
        "n_test", "n_changed",
        reached.scalar().alias("recall_reached"),
        report.agg(F.count(F.lit(1))).scalar().alias("n_report"),
        gate.agg(F.array_join(F.sort_array(F.collect_list("kpi")), ",")).scalar().alias("gates"),
        versions.agg(F.count(F.lit(1))).scalar().alias("n_versions"),
        F.lit(live["stage"]).alias("stage"),
    )


def score_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored by a model that was saved and loaded again, with the checks on every decision."""
    rows = _gold(spark, sf_dir)
    chosen = _linear(rows)
    test = training.training_table(rows, schemas.MODEL_FEATURES).where("split = 'test'")
    tuned = evaluation.calibrated_threshold(training.scored(chosen.models["LR"], test)).first()
    path = scratch_path(spark, "model")
    registry.save_model(chosen.models["LR"], path, schemas.MODEL_FEATURES, tuned["threshold"])
    model, features, threshold = registry.load_model(spark, path)
    decided = scoring.score_batch(
        request_table(spark, sf_dir), scoring.fitted_model(model), threshold, MODEL_VERSION, features
    )
    p = F.col("fraud_probability")
    # The probability is rounded to four digits, the decision is not.
    return decided.select(
        "transaction_id",
        p.between(0.0, 1.0).alias("in_range"),
        ((F.col("is_fraud") == (p >= threshold)) | (F.abs(p - threshold) <= 5e-5)).alias("consistent"),
        "model_version",
    )


def combined_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction with its anomaly score, classifier probability and their mean, checked row by row."""
    rows = _gold(spark, sf_dir)
    table = rows.na.fill(0, subset=schemas.MODEL_FEATURES)
    forest = isolation.fit_isolation_forest(table, schemas.MODEL_FEATURES)
    model = scoring.fitted_model(_linear(rows).models["LR"])
    scores = (
        model(table)
        .select("transaction_id", "probability", forest.score().alias("anomaly_score"))
        .withColumn(
            "combined", isolation.combined_score(F.col("anomaly_score"), F.col("probability"))
        )
    )
    a, p, both = F.col("anomaly_score"), F.col("probability"), F.col("combined")
    return scores.select(
        "transaction_id",
        (a.between(0.0, 1.0) & p.between(0.0, 1.0)).alias("in_range"),
        (F.abs(both - (a + p) / 2) < 1e-9).alias("is_mean"),
    )


def plain_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run table whose models are plain scores: one row per score with its AUC."""
    tx = transactions(spark, sf_dir)
    # A run starts with the last transaction of its share of the table.
    share = F.col("transaction_id") % len(PLAIN_SCORES)
    begun = tx.groupBy(share.alias("seq")).agg(F.max("timestamp").alias("at"))
    table = None
    for seq, (name, score) in enumerate(PLAIN_SCORES.items()):
        scored = tx.select("is_fraud", F.expr(score).alias("score"))
        run = evaluation.auc_roc(scored).select(
            F.concat(F.lit("run-"), F.lit(name)).alias("run_id"),
            F.lit("plain-scores").alias("experiment"),
            F.lit(name).alias("run_name"),
            F.lit(seq).alias("seq"),
            F.timestamp_seconds(begun.where(F.col("seq") == seq).select("at").scalar()).alias("start_time"),
            F.create_map(F.lit("score"), F.lit(score)).alias("params"),
            F.create_map(F.lit("auc_roc"), F.col("auc_roc")).alias("metrics"),
        )
        table = run if table is None else table.unionByName(run)
    return table


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = training.best_model(plain_runs(spark, sf_dir))
    return rounded(best.select("run_name", F.col("metrics")["auc_roc"].alias("auc_roc")), "auc_roc")


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.latest_run(plain_runs(spark, sf_dir), "plain-scores")


def boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The penalised model with its published settings, saved, loaded and held against the test rows."""
    table = training.training_table(_gold(spark, sf_dir), schemas.MODEL_FEATURES)
    fitted = boosting.fit(table.where("split = 'train'"), schemas.MODEL_FEATURES)
    path = scratch_path(spark, "boosted")
    fitted.save(spark, path)
    model = boosting.Boosted.load(spark, path)
    scores = model.score(table.where("split = 'test'")).select(
        "transaction_id", "is_fraud", F.col("probability").alias("score")
    )
    return scores.agg(
        F.count(F.lit(1)).alias("n_test"), F.sum("is_fraud").cast("long").alias("n_fraud"),
        F.coalesce(F.every(F.col("score").between(0.0, 1.0)), F.lit(True)).alias("in_range"),
    ).select(
        F.lit(len(model.trees)).alias("n_trees"), "n_test", "n_fraud", "in_range",
        (evaluation.auc_roc(scores, digits=None).scalar() > AUC_FLOOR).alias("above_floor"),
    )


def boosted_root_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gain of the best first cut of each feature under both penalties, over 64 bins of equal width."""
    tx = transactions(spark, sf_dir)
    features = ["amount", "V14", "V17"]
    return boosting.root_gains(tx, features, edges=boosting.width_edges(tx, features, 64))


LEARNED: dict[str, Query] = {
    "boosted_trees": boosted_trees,
    "boosted_root_gains": boosted_root_gains,
    "best_model": best_model,
    "latest_run": latest_run,
    "model_comparison": model_comparison,
    "model_metrics": model_metrics,
    "feature_importance": feature_importance,
    "model_importances": model_importances,
    "promote": promote,
    "training_chain": training_chain,
    "score_fitted": score_fitted,
    "combined_score": combined_score,
}
