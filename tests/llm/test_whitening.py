import numpy as np
import pytest

from cardwatch.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, id string, x int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], SCHEMA)


def plain(rows, k=8):
    """The definition by an eigendecomposition of the covariance."""
    x = np.floor(1024 * np.array([v for _, v in rows])).astype(int) + 100_000
    n, s = len(x), x.sum(axis=0)
    a = (n * x - s) / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1]
    return n, [sum((int(n) * int(c) - int(t)) ** 2 for c, t in zip(r, s)) for r in x], e[:k], a @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def held(spark, rows, d):
    got = whitening.whitened(frame(spark, rows).repartition(3)).collect()
    n, deviation, e, w, share = plain(rows)
    k = min(8, d)
    assert len(got) == len(rows) * k
    by = {(r["id"], r["component"]): r for r in got}
    for c in range(1, k + 1):
        mine = np.array([by[i, c]["whitened"] for i, _ in rows])
        sign = np.sign(mine @ w[:, c - 1])
        assert np.abs(sign * mine - w[:, c - 1]).max() < 1e-6
        assert by[rows[0][0], c]["explained"] == pytest.approx(share[c - 1], rel=1e-6)
    for i, (key, _) in enumerate(rows):
        assert (by[key, 1]["n"], int(by[key, 1]["deviation"])) == (n, deviation[i])
        assert by[key, 1]["identity_error"] < 1e-8


@pytest.mark.parametrize("d, scale", [(3, 1.0), (12, 1.0), (12, 1e4)])
def test_equals_the_definition(spark, d, scale):
    rng = np.random.default_rng(d)
    mix = rng.normal(size=(d, d)) * np.logspace(0, -1, d)
    held(spark, [(i, [float(c) for c in scale * (mix @ rng.normal(size=d))]) for i in range(400)], d)


def test_ill_conditioned(spark):
    """One dimension a million times as wide as the others, which 64-bit products of raw entries would drown."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(1e6 * rng.normal()), *(float(c) for c in rng.normal(size=5))]) for i in range(300)]
    held(spark, rows, 6)


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(200):
        a, b = (float(c) for c in rng.integers(-9, 9, 2))
        rows.append((i, [a, b, a + b, 7.0, a]))
    got = whitening.whitened(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-6
    n, _, e, _, share = plain(rows, 2)
    assert sorted({round(r["explained"], 6) for r in got}, reverse=True) == [round(float(s), 6) for s in share]


def test_odd_rows(spark):
    good = [(i, [float(i % 3), float(i % 5), float(i * i % 7)]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1.0, 2.0, 3.0, 4.0]), (107, [1e300, 0.0, 0.0])]
    got = whitening.whitened(frame(spark, good + bad + [(None, [0.5, 0.5, 0.5]), (0, [0.0, 0.0, 0.0])])).collect()
    assert len(got) == 42 * 3 and {r["n"] for r in got} == {42}
    assert sum(r["id"] is None for r in got) == 3 and sum(r["id"] == 0 for r in got) == 6
    assert not {r["id"] for r in got} & set(range(100, 108))


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(frame(spark, rows)).collect() == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(i) * 1e9, float(i % 2)]) for i in range(50)]
    _, deviation, *_ = plain(rows)
    got = whitening.whitened(frame(spark, rows)).where("component = 1").collect()
    assert {r["id"]: int(r["deviation"]) for r in got} == {i: deviation[i] for i in range(50)}
