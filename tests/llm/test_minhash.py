import random

import numpy as np
import pytest

from cardwatch.llm import minhash, wordhash
from tests.llm import brute
from tests.llm.test_ngram_join import SCHEMA, corpus, rows_of


def test_values_agree_as_often_as_sets_do():
    """Unbiased, and with no more spread than minima under twice as many permutations."""
    rng = np.random.default_rng(1)
    both, single = [], []
    for _ in range(150):
        s = wordhash.mix(rng.integers(0, 1 << 63, 30, np.uint64))
        tokens, heads = np.concatenate([np.sort(s[:25]), np.sort(s[5:])]), np.array([0, 25])
        low, high = minhash.signatures(tokens, heads, 64)
        equal = lambda v: float((v[0] == v[1]).mean())
        both.append((equal(low) + equal(high)) / 2)
        single.append(equal(minhash.signatures(tokens, heads, 128)[0]))
    assert np.mean(both) == pytest.approx(20 / 30, abs=0.02)
    assert np.std(both) < 1.1 * np.std(single)


@pytest.mark.parametrize("seed, tokens", [(1, minhash.BLOCK_TOKENS), (2, 90)])
def test_equals_brute_force(spark, seed, tokens):
    rows = corpus(seed)
    got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), block_tokens=tokens)
    assert rows_of(got) == brute.components(rows, width=4)
    assert got.where("kept <> (doc_id = component_id)").count() == 0


def chain(rng, n):
    """Texts of which each is like the next but ever less like the first, and a far one that meets the middle."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    rows = []
    for i in range(n):
        rows.append((i, " ".join(words)))
        words = words[1:] + [f"w{rng.randrange(10**6)}"]
    return rows


def test_members_unlike_their_leader_are_linked(spark, monkeypatch):
    """Buckets in which the leader is like few of the others, and leaders of several pieces."""
    monkeypatch.setattr(minhash, "PIECE", 7)
    rng = random.Random(4)
    rows = chain(rng, 30)
    common = " ".join(f"c{i}" for i in range(40))
    rows += [(100 + i, common + " " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 25])))) for i in range(40)]
    rng.shuffle(rows)
    for tokens in (10**6, 300):
        got = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), block_tokens=tokens)
        assert rows_of(got) == brute.components(rows, width=4)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 5000}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"), (None, None), (7, long),
        (8, long + " tail"), (4, "one"), (4, "other words here now"), (-3, "One\x0b"), (None, "q r s t u"), (9, "a " * 9),
    ]
    df = spark.createDataFrame([(*r, "x", 1, b"p") for r in rows], SCHEMA + ", label string, band int, print binary")
    assert rows_of(minhash.near_duplicates(df)) == brute.components(rows, width=4)


def test_empty_table(spark):
    assert rows_of(minhash.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
