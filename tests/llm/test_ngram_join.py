import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from cardwatch.llm import ngram_join
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Zürich", "ÉTÉ", "x y"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.4 and rows:
            words = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            text = " ".join(words)
        elif kind < 0.6:
            text = passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 9, 40])))
        else:
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 20, 60])))
        rows.append((i * 7 % n, text.upper() if rng.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize("seed, tokens", [(1, ngram_join.GROUP_TOKENS), (2, 200), (3, 60)])
def test_equals_brute_force(spark, seed, tokens):
    rows = corpus(seed)
    got = ngram_join.near_duplicates(
        spark.createDataFrame(rows, SCHEMA).repartition(3), group_tokens=tokens
    )
    assert rows_of(got) == brute.components(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 5000}" for i in range(20_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one"),
        (None, None), (7, long), (8, long + " tail"), (4, "one"), (4, "other words here"), (-3, "One\x0b"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", size string, token int")
    assert rows_of(ngram_join.near_duplicates(df)) == brute.components(rows)


def test_empty_table(spark):
    assert rows_of(ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA))) == []


def test_one_of_each(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, ""), (4, None), (5, "q r s t u v"), (6, "z"),
            (6, "z"), (7, "z"), (None, "n o p")]
    df = spark.createDataFrame([(*r, "src") for r in rows], SCHEMA + ", source string")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r[0] is None, r[0] or 0, r[1] or "") for r in kept.collect()) == [
        (False, 1, "a b c d e f"), (False, 3, ""), (False, 4, ""), (False, 5, "q r s t u v"),
        (False, 6, "z"), (True, 0, "n o p"),
    ]


def test_rows_that_share_an_id_are_judged_by_their_sets(spark):
    a, b = ([f"{x}{i}" for i in range(40)] for x in "ab")
    a, b, a_near, b_near = (" ".join(w) for w in (a, b, ["z", *a], ["z", *b]))
    cases = [
        ([(5, a), (5, b)], {(5, a), (5, b)}),
        ([(3, a_near), (5, a), (5, b), (9, b_near)], {(3, a_near), (5, b)}),
        ([(None, a), (None, a), (None, a_near), (None, b), (7, b_near)], {(7, b_near)}),
        ([(None, None), (None, ""), (5, ""), (5, ""), (5, a), (5, a.upper())], {(5, a.upper())}),
    ]
    for rows, expected in cases:
        seen = []
        for order in (rows, rows[::-1]):
            kept = ngram_join.one_of_each(spark.createDataFrame(order, SCHEMA).repartition(3)).collect()
            full = [(r.doc_id, r.text) for r in kept if r.text]
            assert len(kept) - len(full) == sum(not t for _, t in rows)
            assert len(full) == len(set(full))
            seen.append(set(full))
        assert seen[0] == seen[1] and expected <= seen[0]
        assert len(seen[0]) == len(expected) + (rows[0] == (None, a))


def test_small_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(ngram_join.near_duplicates(docs)) == brute.components(rows)


def test_words_that_collide_in_polynomial_hashes_differ(spark):
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, thue), (2, thue.translate(str.maketrans("ab", "ba"))), (3, thue[:8] * 3), (4, thue[:8] * 3 + "a")]
    assert rows_of(ngram_join.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute.components(rows)


def test_a_bucket_is_counted_in_little_more_memory_than_its_tokens():
    rng = np.random.default_rng(3)
    n, rows = 50_000, []
    shared = rng.integers(0, 2**64, 10, np.uint64)
    for i in range(16):
        tokens = np.append(rng.integers(0, 2**64, n - 10, np.uint64), shared)
        prints = rng.integers(0, 2**64, 2 * n // 100, np.uint64)
        sizes = counts = np.full(n // 100, 100, np.uint32)
        rows.append((0, prints.tobytes(), sizes.tobytes(), counts.tobytes(), tokens.tobytes()))
    batch = ngram_join._blob_rows(rows)
    del rows
    tracemalloc.start()
    out = list(ngram_join._count_bucket(iter([batch]), 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 * 16 * n  # bytes; a token has eight
    # Tokens that two or more classes have come back once for each of them.
    found = np.frombuffer(pa.Table.from_batches(out).column("tokens")[0].as_py(), np.uint64)
    assert sorted(found.tolist()) == sorted(shared.tolist() * 16)
