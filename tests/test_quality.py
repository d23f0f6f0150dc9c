import random
import statistics

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators import quality, quantiles
from cardwatch.sources import requests

GOOD = dict(
    transaction_id="t", amount=77.0, velocity_1h=1.5, night_tx_ratio=0.08, V14=0.02, V17=0.01
)


def table(spark, *rows):
    names = [f.name for f in schemas.REQUEST.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schemas.REQUEST)


@pytest.mark.parametrize(
    "change, rule",
    [
        ({"amount": -5.0}, "amount_range"),
        ({"amount": 0.0}, "amount_range"),
        ({"amount": 50000.0}, "amount_range"),
        ({"amount": 60000.0}, "amount_range"),
        ({"amount": float("nan")}, "amount_range"),
        ({"velocity_1h": -1.0}, "velocity_1h_range"),
        ({"velocity_1h": 99.0}, "velocity_1h_range"),
        ({"night_tx_ratio": 1.5}, "night_tx_ratio_range"),
        ({"velocity_1h_calc": 50.5}, "velocity_1h_calc_range"),
        ({"risk_score": 1.01}, "risk_score_range"),
        ({"V14": None}, "V14_missing"),
        ({"amount": None}, "amount_missing"),
    ],
)
def test_rule_is_reported(spark, change, rule):
    row = quality.validate(table(spark, {**GOOD, **change})).first()
    assert row["violations"] == [rule]


@pytest.mark.parametrize(
    "change",
    [{}, {"amount": 0.01}, {"amount": 49999.99}, {"velocity_1h": 0.0}, {"velocity_1h": 50.0},
     {"night_tx_ratio": 0.0}, {"night_tx_ratio": 1.0}, {"risk_score": 1.0}],
)
def test_bounds_are_valid(spark, change):
    checked = quality.validate(table(spark, {**GOOD, **change}))
    assert quality.accepted(checked).count() == 1 and quality.rejected(checked).count() == 0


def test_absent_column_counts_as_missing(spark):
    df = table(spark, GOOD).drop("V17")
    assert quality.validate(df).first()["violations"] == ["V17_missing"]


def test_defaults_and_zero_fallback(spark):
    df = table(spark, GOOD, {**GOOD, "velocity_1h_calc": 4.0, "zscore_amount": 2.0,
                             "zscore_amount_calc": 0.0, "risk_score": 0.0})
    filled = quality.apply_defaults(df.drop("merchant_category"))
    assert {r["merchant_category"] for r in filled.collect()} == {"unknown"}
    plain, given = quality.resolve_features(filled).collect()
    assert (plain["velocity_1h_calc"], plain["zscore_amount_calc"], plain["risk_score"]) == (
        1.5, 0.0, 0.1)
    assert (given["velocity_1h_calc"], given["zscore_amount_calc"], given["risk_score"]) == (
        4.0, 2.0, 0.1)


def test_json_round_trip(spark, tmp_path):
    df = table(spark, GOOD, {**GOOD, "transaction_id": "u", "V4": 2.5})
    requests.encode_requests(df).write.text(str(tmp_path / "in"))
    back = requests.read_requests(spark, str(tmp_path / "in"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_silver_keeps_the_earliest_copy(spark):
    rows = [("a", 20, 1.0, " fr ", 0.5), ("a", 10, 2.0, "fr", 0.5), ("b", 1, None, "de", 0.1),
            ("c", 1, 1.0, "it", float("inf")), ("d", 1, 1.0, "it", float("nan"))]
    df = spark.createDataFrame(
        rows, "transaction_id string, timestamp long, amount double, country string, V1 double")
    got = quality.silver_clean(df, ["transaction_id", "amount", "country"])
    assert [tuple(r) for r in got.collect()] == [("a", 10, 2.0, "FR", 0.5)]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 400])
def test_exact_quantiles(spark, n):
    rng = random.Random(n)
    values = [float(rng.choice([7, 7, 7, rng.randrange(1000)])) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}
    got = quantiles.exact_quantiles(df, "x", points).first()
    for name, p in points.items():
        if n == 0:
            assert got[name] is None
            continue
        s, place = sorted(values), p * (n - 1)
        low = int(place)
        want = s[low] + (s[min(low + 1, n - 1)] - s[low]) * (place - low)
        assert got[name] == pytest.approx(want)


def test_approximate_quantiles_stay_within_their_rank_error(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    got = quantiles.approximate_quantiles(df, "x", {"q1": 0.25, "q3": 0.75}, 0.01).first()
    assert abs(got["q1"] - 2500) <= 100 and abs(got["q3"] - 7500) <= 100


def test_outliers(spark):
    values = [10.0, 11.0, 12.0, 13.0, 14.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "amount double")
    report = quality.outlier_report(df).first()
    q1, _, q3 = statistics.quantiles(values, n=4, method="inclusive")
    assert (report["q1"], report["q3"], report["n_outliers"]) == (q1, q3, 1)
    assert [r["amount"] for r in quality.outliers(df).collect()] == [100.0]


def test_synthetic_mix(spark):
    df = requests.synthetic_mix(spark, 5000)
    shares = {r["kind"]: r["count"] / 5000 for r in df.groupBy("kind").count().collect()}
    assert shares["legit"] == pytest.approx(0.7, abs=0.03)
    assert shares["card_testing"] == pytest.approx(0.2, abs=0.03)
    assert df.where("kind = 'repeat'").select("transaction_id").distinct().count() == 1
    assert quality.rejected(quality.validate(df)).count() == 0


def test_requests_are_parsed_once_however_many_rules_look_at_them(spark):
    lines = ['{"transaction_id":"a","amount":5.0,"velocity_1h":1.0,"night_tx_ratio":0.1,"V14":0.0,"V17":0.0}',
             '{"transaction_id":"b","amount":"high"}', '{"transaction_id":"c","amount":-5.0}', "[1]", "", None]
    taken, rescued = quality.route(requests.ingest(spark.createDataFrame([(x,) for x in lines], "value string")))
    for part in (taken, rescued):
        text = part._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json(") == 1 and text.count("parseJson(") == 1
    assert [r["transaction_id"] for r in taken.collect()] == ["a"]
    found = sorted((r["body"] or "", r["reasons"][0]) for r in rescued.collect())
    assert found == [("", "malformed"), ("", "malformed"), ("", "velocity_1h_missing"), ("[1]", "malformed"), (lines[1], "wrong_type")]
