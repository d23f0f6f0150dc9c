import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cardwatch.operators import evaluation, profiles, sampling, selection


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.3)
        s = round(min(1.0, max(0.0, rng.gauss(0.4 + 0.25 * y, 0.2))), rng.choice([1, 2, 6]))
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "transaction_id long, is_fraud int, score double")


def brute_auc(rows):
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def test_auc_on_raw_scores(scored):
    rows, df = scored
    got = evaluation.auc_roc(df, digits=None).first()[0]
    assert got == pytest.approx(brute_auc(rows))
    ranked = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="is_fraud", numBins=0)
    assert got == pytest.approx(ranked.evaluate(df))


def test_auc_flips_with_the_sign(scored):
    _, df = scored
    turned = df.withColumn("score", -F.col("score"))
    assert evaluation.auc_roc(turned, digits=None).first()[0] == pytest.approx(
        1 - evaluation.auc_roc(df, digits=None).first()[0]
    )


def test_auc_without_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "is_fraud int, score double")
    assert evaluation.auc_roc(df).first()[0] is None


def test_threshold_and_curve(scored):
    rows, df = scored
    n_pos = sum(y for _, y, _ in rows)
    n_neg = len(rows) - n_pos
    curve = {r["threshold"]: (r["tpr"], r["fpr"]) for r in evaluation.roc_curve(df, digits=None).collect()}
    assert set(curve) == {s for *_, s in rows}
    for t, (tpr, fpr) in curve.items():
        assert tpr == pytest.approx(sum(y and s >= t for _, y, s in rows) / n_pos)
        assert fpr == pytest.approx(sum((not y) and s >= t for _, y, s in rows) / n_neg)
    best = evaluation.calibrated_threshold(df, digits=None).first()
    assert best["threshold"] == max(t for t, (tpr, _) in curve.items() if tpr >= 0.9)


def test_threshold_of_one_becomes_a_half(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.2)], "is_fraud int, score double")
    assert evaluation.calibrated_threshold(df).first()["threshold"] == 0.5


def test_corners_leave_out_points_on_a_line(spark):
    rows = [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5)]
    df = spark.createDataFrame(rows, "is_fraud int, score double")
    got = evaluation.roc_curve(df, corners_only=True)
    assert sorted(r["threshold"] for r in got.collect()) == [0.5, 0.7, 0.9]


def test_confusion_adds_up(scored):
    rows, df = scored
    m = evaluation.confusion_matrix(df, 0.5).first()
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == len(rows)
    assert m["tp"] == sum(y and s >= 0.5 for _, y, s in rows)


def test_metrics_without_hits_are_zero(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "is_fraud int, score double")
    row = evaluation.metrics_of(evaluation.confusion_matrix(df, 0.9)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_kpi_gate_is_strict(spark):
    df = spark.createDataFrame(
        [(0.95, 0.91, 0.93, 0.99)], "precision double, recall double, f1 double, auc_roc double")
    got = {r["kpi"]: r["pass"] for r in evaluation.kpi_gate(df).collect()}
    assert got == {"precision": False, "recall": True, "f1": True, "auc_roc": True}


def test_histogram_puts_one_into_the_last_bin(spark):
    df = spark.createDataFrame(
        [(0.0, True), (0.05, True), (1.0, True)], "fraud_probability double, is_fraud boolean")
    got = sorted(r["bin"] for r in evaluation.probability_histogram(df).collect())
    assert got == [0, 1, 19]


def test_country_without_a_class_has_no_rate(spark):
    df = spark.createDataFrame([("FR", 0), ("FR", 1), ("DE", 0)], "country string, is_fraud int")
    rows = [tuple(r) for r in profiles.country_pivot(df).collect()]
    assert rows == [("FR", 1, 1, 50.0), ("DE", 1, None, None)]


def test_profile_gives_the_figures_the_table_has(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 4.0)], "is_fraud int, V14 double")
    got = profiles.vfeature_profile(df)
    assert got.columns == ["is_fraud", "V14_moy", "V14_std"]
    assert [tuple(r) for r in got.collect()] == [(0, 1.5, 0.707), (1, 4.0, None)]
    assert [r[0] for r in profiles.class_profile(df, []).collect()] == [0, 1]


def test_class_weights_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "is_fraud int")
    row = profiles.class_weights(df).first()
    assert row["scale_pos_weight"] is None and row["weight_neg"] == 0.5


def test_selection(spark):
    rows = [(i, i % 2, float(i % 2) * 3 + i * 0.01, 5.0, float(i)) for i in range(100)]
    df = spark.createDataFrame(
        rows, "transaction_id long, is_fraud int, strong double, flat double, weak double")
    assert selection.numeric_features(df) == ["strong", "flat", "weak"]
    kept = {r["feature"]: r["kept"] for r in selection.variance_filter(df).collect()}
    assert kept == {"strong": True, "flat": False, "weak": True}
    assert selection.select_top_features(df, k=20) == ["strong", "weak"]
    assert selection.select_top_features(df, k=1) == ["strong"]


@pytest.mark.parametrize("fraction", [0.01, 0.2, 0.8])
def test_samples_have_their_share(spark, fraction):
    """Within four standard deviations of a binomial count, and a hundredth of the rows."""
    df = spark.range(200_000).withColumnRenamed("id", "transaction_id")
    got = sampling.hash_sample(df, fraction).count() / 200_000
    assert abs(got - fraction) < min(0.01, 4 * (fraction * (1 - fraction) / 200_000) ** 0.5)


@pytest.mark.parametrize("n, train", [(20_000, 0.8), (7, 0.5), (1, 0.8), (3, 0.0), (3, 1.0)])
def test_exact_split(spark, n, train):
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"), F.when(F.col("id") % 7 > 0, (F.col("id") % 3 == 0).cast("int")).alias("is_fraud"))
    split = sampling.exact_split(df, train)
    sizes = {r[0]: r[1] for r in df.groupBy("is_fraud").count().collect()}
    counts = {(r[0], r[1]): r[2] for r in sampling.split_counts(split).collect()}
    for label, size in sizes.items():
        assert counts.get((label, "train"), 0) == int(train * size + 0.5)
    assert split.exceptAll(sampling.exact_split(df.repartition(5), train)).count() == 0


def test_split_is_stable_and_proportional(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("transaction_id"), (F.col("id") % 10 == 0).cast("int").alias("is_fraud"))
    split = sampling.stratified_split(df)
    counts = {(r[0], r[1]): r[2] for r in sampling.split_counts(split).collect()}
    for label, n in ((0, 18_000), (1, 2_000)):
        assert counts[label, "train"] / n == pytest.approx(0.8, abs=0.01)
    again = sampling.stratified_split(df.repartition(13))
    assert split.exceptAll(again).count() == 0
    assert sampling.hash_sample(df).count() == pytest.approx(4_000, rel=0.1)


def test_close_scores_stay_apart(spark):
    rows = [(0.50001, 1), (0.50002, 0), (0.50003, 1), (0.50004, 1)]
    df = spark.createDataFrame(rows, "score double, is_fraud int")
    assert evaluation.auc_roc(df).first()["auc_roc"] == pytest.approx(2 / 3)
    frauds = spark.createDataFrame([(0.84996, 1)] * 10 + [(0.1, 0)] * 10, "score double, is_fraud int")
    cut = evaluation.calibrated_threshold(frauds).first()["threshold"]
    assert evaluation.confusion_matrix(frauds, cut).first()["tp"] == 10


def test_metrics_from_one_summary_equal_the_confusion_matrix(spark):
    rows = [((i * 37 % 101) / 50, int(i * 53 % 7 < 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "score double, is_fraud int")
    for r in evaluation.binary_metrics(df).collect():
        want = evaluation.metrics_of(evaluation.confusion_matrix(df, float(r["threshold"]))).first()
        assert (r["precision"], r["recall"], r["f1"]) == (want["precision"], want["recall"], want["f1"])
