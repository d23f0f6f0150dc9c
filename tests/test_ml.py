import pytest
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.ml import isolation, registry, training
from cardwatch.operators import gold, quality, sampling, scoring
from cardwatch.plans import learned
from cardwatch.sources import derived
from cardwatch.sources.tables import transactions


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    features = gold.compute_features(transactions(spark, sf_dir, pca=True)).cache()
    yield features
    features.unpersist()


@pytest.fixture(scope="module")
def compared(table):
    return training.compare_models(table, trees=10)


def test_models_beat_the_floor(compared):
    rows = {r["run_name"]: r["metrics"] for r in compared.runs.collect()}
    assert set(rows) == {"GBT", "RF", "LR"}
    assert all(m["auc_roc"] > 0.9 for m in rows.values())
    assert all(set(m) == {"auc_roc", "f1", "precision", "recall"} for m in rows.values())


def test_run_parameters(compared):
    row = compared.runs.where("run_name = 'LR'").first()
    assert row["params"]["features"] == ", ".join(schemas.MODEL_FEATURES)
    assert row["params"]["C"] == "0.1"


def test_first_of_equal_models_wins(spark):
    rows = [("r1", "e", "A", 0, None, {}, {"auc_roc": 0.9}),
            ("r2", "e", "B", 1, None, {}, {"auc_roc": 0.95}),
            ("r3", "e", "C", 2, None, {}, {"auc_roc": 0.95})]
    runs = spark.createDataFrame(rows, schemas.RUNS)
    assert training.best_model(runs).first()["run_name"] == "B"


def test_importance_is_ordered(spark, compared):
    for model in compared.models.values():
        rows = training.feature_importance(model, spark).collect()
        assert [r["importance"] for r in rows] == sorted(
            (r["importance"] for r in rows), reverse=True)
        assert {r["feature"] for r in rows} == set(schemas.MODEL_FEATURES)


def test_promotion_archives_the_version_before(spark):
    versions = registry.no_versions(spark)
    for run in ("a", "b"):
        versions = registry.promote(versions, "m", run, f"/models/{run}")
    versions = registry.promote(versions, "other", "c", "/models/c")
    got = sorted((r["name"], r["version"], r["stage"], r["run_id"]) for r in versions.collect())
    assert got == [("m", 1, "Archived", "a"), ("m", 2, "Production", "b"),
                   ("other", 1, "Production", "c")]
    assert registry.in_production(versions, "m").first()["run_id"] == "b"


def test_saved_model_scores_alike(spark, compared, table, tmp_path):
    path = str(tmp_path / "model")
    registry.save_model(compared.models["LR"], path, schemas.MODEL_FEATURES, 0.84949)
    model, features, threshold = registry.load_model(spark, path)
    assert (features, threshold) == (schemas.MODEL_FEATURES, 0.849)
    filled = table.na.fill(0)
    a = training.scored(compared.models["LR"], filled)
    b = training.scored(model, filled)
    assert a.exceptAll(b).count() == 0


def test_scoring_does_not_depend_on_row_order(spark, sf_dir):
    requests = derived.requests(transactions(spark, sf_dir))
    model = scoring.linear_model({"V14": -1.0, "unknown": 3.0}, 0.0)
    features = ["V14", "unknown"]
    a = scoring.score_batch(requests, model, 0.5, "v", features)
    b = scoring.score_batch(requests.orderBy(F.desc("amount")), model, 0.5, "v", features)
    assert a.exceptAll(b).count() == 0
    assert a.count() == quality.accepted(quality.validate(requests)).count()


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.4999,)], "probability double")
    got = [r["is_fraud"] for r in scoring.decide(df, 0.5, "v").collect()]
    assert got == [True, False]


def test_registered_training_queries_read_the_tables(spark, sf_dir):
    assert learned.plain_runs(spark, sf_dir).count() == len(learned.PLAIN_SCORES)


def test_isolation_forest_finds_the_outlier(spark):
    rows = [(i, (i * 37 % 101) / 101, (i * 53 % 97) / 97) for i in range(2000)]
    rows.append((2000, 9.0, -9.0))
    df = spark.createDataFrame(rows, "transaction_id long, a double, b double")
    forest = isolation.fit_isolation_forest(df, ["a", "b"], trees=50, subsample=64)
    assert len(forest.trees) == 50
    scored = df.withColumn("s", forest.score()).orderBy(F.desc("s")).collect()
    assert scored[0]["transaction_id"] == 2000 and scored[0]["s"] > scored[1]["s"]
    assert all(0 < r["s"] < 1 for r in scored)


def test_isolation_forest_does_not_depend_on_partitioning(spark):
    df = spark.range(3000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 71).alias("a"))
    one = isolation.fit_isolation_forest(df, ["a"], trees=5)
    two = isolation.fit_isolation_forest(df.repartition(7), ["a"], trees=5)
    assert all((x["cut"] == y["cut"]).all() for x, y in zip(one.trees, two.trees, strict=True))


def test_paths_of_small_samples():
    assert isolation._path_length(1) == 0 and isolation._path_length(2) == 1
    assert isolation._path_length(256) == pytest.approx(10.24, abs=0.01)


def test_linear_importance_does_not_depend_on_scale(spark):
    rows = [(i, int((i * 7919) % 10 < 5), float((i * 7919) % 10 < 5) + (i * 31 % 17) / 17) for i in range(600)]
    df = spark.createDataFrame(rows, "transaction_id long, is_fraud int, a double").withColumn("b", F.col("a") * 1000)
    model = training.compare_models(df, ["a", "b"], only=("LR",)).models["LR"]
    small, large = (r["importance"] for r in training.feature_importance(model, spark).orderBy("feature").collect())
    assert small == pytest.approx(large, rel=1e-3) and small > 0


def test_class_weights_come_from_training_rows(table):
    train = training.training_table(table, schemas.MODEL_FEATURES).where("split = 'train'")
    weighted = training.weighted(train)
    total, n = weighted.agg(F.sum(training.WEIGHT), F.count(F.lit(1))).first()
    assert total == pytest.approx(n)


def test_chosen_threshold_reaches_the_recall(table):
    from cardwatch.operators import evaluation

    chosen = training.choose(table, trees=5)
    got = evaluation.metrics_of(evaluation.confusion_matrix(chosen.scores, chosen.threshold)).first()
    assert got["recall"] >= 0.90
    best = training.latest_run(chosen.runs).first()["run_id"]
    row = chosen.runs.where(F.col("run_id") == best).first()
    assert row["run_name"] == f"best-{chosen.name}" and float(row["params"]["threshold"]) == chosen.threshold


def test_only_a_better_run_is_promoted(spark):
    runs = spark.createDataFrame(
        [(r, "e", r, i, None, {}, {"auc_roc": a}) for i, (r, a) in enumerate([("a", 0.8), ("b", 0.8), ("c", 0.9)])],
        schemas.RUNS,
    )
    versions = registry.no_versions(spark)
    for run in "abc":
        versions = registry.promote_if_better(versions, runs, "m", run, f"/{run}")
    assert [(r["run_id"], r["stage"]) for r in versions.orderBy("version").collect()] == [
        ("a", "Archived"), ("c", "Production")]


def test_registered_fits_take_the_default_trees_and_return_values(spark, sf_dir, compared, monkeypatch):
    asked = []
    monkeypatch.setattr(training, "compare_models", lambda df, **given: asked.append(given) or compared)
    metrics = {r["run_name"]: r for r in learned.LEARNED["model_metrics"](spark, sf_dir).collect()}
    for run in compared.runs.collect():
        assert all(metrics[run["run_name"]][k] == v for k, v in run["metrics"].items())
    rows = learned.LEARNED["model_importances"](spark, sf_dir).collect()
    assert len(rows) == 3 * len(schemas.MODEL_FEATURES)
    assert sum(r["importance"] for r in rows if r["run_name"] == "RF") == pytest.approx(1)
    learned.model_comparison(spark, sf_dir)
    learned.feature_importance(spark, sf_dir)
    assert asked == [{}] * 4


def test_training_chain_takes_the_default_trees(spark, sf_dir, monkeypatch):
    class Asked(Exception):
        pass

    def choose(df, **given):
        raise Asked(given)

    monkeypatch.setattr(training, "choose", choose)
    with pytest.raises(Asked) as told:
        learned.training_chain(spark, sf_dir)
    assert told.value.args == ({},)


def test_split_leaves_the_rows_where_they_are(spark):
    """Dealt by the label, the table would lie in two tasks, and every pass of a fit with it."""
    rows = spark.range(0, 4000, 1, 8).select(F.col("id").alias("transaction_id"), (F.col("id") % 10 == 0).cast("int").alias("is_fraud"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = sampling.exact_split(rows)
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        trained = split.where("split = 'train'").groupBy("is_fraud").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(sizes) == [500] * 8
    assert {r["is_fraud"]: r["count"] for r in trained} == {0: 2880, 1: 320}
