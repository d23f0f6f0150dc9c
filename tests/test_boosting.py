"""Penalised boosting against plain sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwatch.ml import boosting
from cardwatch.ml.boosting import Penalised
from cardwatch.operators import evaluation

SCHEMA = "transaction_id long, is_fraud int, a double, b double"


def test_gain_by_hand():
    """Ten rows in two bins of one feature, margin 0: p = 0.5, so g = +-0.5 and h = 0.25 a row."""
    g, h = np.array([[4 * 0.5, 1 * 0.5 - 5 * 0.5]]), np.array([[4 * 0.25, 6 * 0.25]])
    shrunk = lambda x: np.sign(x) * max(abs(x) - 0.1, 0)
    want = (shrunk(2.0) ** 2 / 2.0 + shrunk(-2.0) ** 2 / 2.5 - shrunk(0.0) ** 2 / 3.5) / 2
    assert boosting.split_gains(g, h, Penalised())[0] == pytest.approx([want])
    assert boosting.split_gains(g, h, Penalised(least_hessian=1.2))[0] == [-np.inf]
    assert boosting._leaf(2.0, 1.0, Penalised()) == pytest.approx(-0.1 * 1.9 / 2.0)


def data(spark, n=3000):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = ((a * b > 0.3) ^ (rng.random(n) < 0.05)).astype(int)  # no single feature tells
    rows = [(i, int(y[i]), float(a[i]), float(b[i])) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, 1.0, 1.0), (n + 1, 1, None, float("nan"))], SCHEMA)


def plain_tree(binned, y, spec, bins, positive):
    """The first tree's first cut, row by row."""
    best = (0.0, None)
    for f in range(binned.shape[1]):
        for cut in range(bins - 1):
            sums = []
            for side in (binned[:, f] <= cut, binned[:, f] > cut, np.ones(len(y), bool)):
                w = np.where(y[side] > 0, positive, 1.0)
                g, h = (w * (0.5 - y[side])).sum(), (w * 0.25).sum()
                sums.append((max(abs(g) - spec.l1, 0) ** 2 / (h + spec.l2), h))
            if min(sums[0][1], sums[1][1]) >= spec.least_hessian:
                gain = (sums[0][0] + sums[1][0] - sums[2][0]) / 2
                best = max(best, (gain, (f, -cut)))
    return best


def test_first_cut_equals_plain_sums(spark):
    df, spec = data(spark), Penalised(trees=1, depth=1, rows=1.0, columns=1.0, bins=8)
    model = boosting.fit(df, ["a", "b"], spec=spec)
    known = df.where("is_fraud IS NOT NULL").toPandas()
    binned = np.stack([np.searchsorted(e, known[c].fillna(-np.inf), "left") for c, e in zip("ab", model.edges)], 1)
    y = known["is_fraud"].to_numpy()
    gain, (feature, cut) = plain_tree(binned, y, spec, 8, (y == 0).sum() / (y == 1).sum())
    assert (model.trees[0].feature[0], model.trees[0].cut[0]) == (feature, -cut)
    root = {r.feature: r.gain for r in boosting.root_gains(df, ["a", "b"], spec=spec).collect()}
    assert max(root.values()) == pytest.approx(gain, abs=1e-5)


def test_learns_an_interaction_and_survives_saving(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "WRITE_EVERY", 4)
    df = data(spark)
    model = boosting.fit(df, ["a", "b"], spec=Penalised(trees=10, rate=0.3, bins=32))
    scores = model.score(df.where("is_fraud IS NOT NULL")).select("transaction_id", "is_fraud", F.col("probability").alias("score"))
    assert evaluation.auc_roc(scores).first()[0] > 0.9
    model.save(spark, f"{tmp_path}/model")
    again = boosting.Boosted.load(spark, f"{tmp_path}/model").score(df).select("transaction_id", "probability")
    assert again.exceptAll(model.score(df).select("transaction_id", "probability")).count() == 0
    other = boosting.fit(df.repartition(5), ["a", "b"], spec=Penalised(trees=10, rate=0.3, bins=32))
    assert [(t.feature, t.cut) for t in other.trees] == [(t.feature, t.cut) for t in model.trees]


def test_penalties_shrink(spark):
    df = data(spark, 400)
    leaves = {
        l2: max(abs(v) for t in boosting.fit(df, ["a", "b"], spec=Penalised(trees=1, l2=l2, rows=1.0)).trees for v in t.value)
        for l2 in (1.0, 100.0)
    }
    assert leaves[100.0] < leaves[1.0]
    assert boosting.fit(df, ["a", "b"], spec=Penalised(trees=2, l1=1e9)).splits() == 0


def test_nothing_to_learn(spark):
    for rows in ([], [(1, 1, 0.0, 0.0)], [(i, 0, 1.0, 2.0) for i in range(9)]):
        df = spark.createDataFrame(rows, SCHEMA)
        model = boosting.fit(df, ["a", "b"], spec=Penalised(trees=2))
        assert model.splits() == 0 and model.score(df).count() == len(rows)


def test_every_tree_is_evaluated_once(spark, monkeypatch):
    """The rows of a level hold the margin of all trees so far, so none of these is evaluated again there."""
    seen, grow = [], boosting._grow

    def watched(rows, *rest):
        seen.append([np.frombuffer(r["__margin"]) + np.frombuffer(r["__since"]) for r in rows.collect()])
        return grow(rows, *rest)

    monkeypatch.setattr(boosting, "_grow", watched)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    model = boosting.fit(data(spark, 300), ["a", "b"], spec=Penalised(trees=4))
    for turn, blocks in enumerate(seen):
        widest = sum(max(map(abs, t.value)) for t in model.trees[:turn])
        assert all((np.abs(b) <= widest + 1e-12).all() for b in blocks)
        assert turn == 0 or max(np.abs(b).max() for b in blocks) > 0
