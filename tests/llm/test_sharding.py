import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwatch.llm import sharding


def pmf(total, good, drawn):
    lo, hi = max(0, drawn + good - total), min(drawn, good)
    c = math.comb
    return {k: c(good, k) * c(total - good, drawn - k) / c(total, drawn) for k in range(lo, hi + 1)}


@pytest.mark.parametrize("total, good, drawn", [(20, 7, 9), (50, 50, 10), (9, 0, 4), (400, 200, 150), (0, 0, 0)])
def test_inversion_gives_the_hypergeometric_law(spark, total, good, drawn):
    n = 4000
    t, g, d = (F.lit(x).cast("long") for x in (total, good, drawn))
    even = spark.range(n).select(sharding.hypergeometric(t, g, d, (F.col("id") + 0.5) / n).alias("k"))
    got = Counter(r.k for r in even.collect())
    for k, p in pmf(total, good, drawn).items():
        assert abs(got[k] / n - p) <= 1.5 / n + 1e-9
    assert set(got) <= set(pmf(total, good, drawn))


def test_large_counts_keep_their_mean_and_spread(spark):
    t, g, d = (F.lit(x).cast("long") for x in (10**9, 4 * 10**7, 5 * 10**5))
    r = spark.range(300).select(sharding.hypergeometric(t, g, d, (F.col("id") + 0.5) / 300).alias("k"))
    mean, spread = r.agg(F.avg("k"), F.stddev("k")).first()
    assert abs(mean - 20_000) < 3 and abs(spread - math.sqrt(5e5 * 0.04 * 0.96)) < 3


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_matrix_has_its_sums(spark, parts):
    sizes = {i: (i * 37) % 90 for i in range(parts)}
    df = spark.createDataFrame(list(sizes.items()), "part int, n long")
    lines = {r.part: r.counts for r in sharding.matrix(df, 5).collect()}
    assert {p: sum(c) for p, c in lines.items()} == sizes
    columns = [sum(c[j] for c in lines.values()) for j in range(5)]
    assert sum(columns) == sum(sizes.values()) and max(columns) - min(columns) <= 1
    assert all(x >= 0 for c in lines.values() for x in c)


def whole(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(j, [])) for j in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))


@pytest.mark.parametrize("n, bucket_rows", [(1000, 10), (5, 10), (0, 10)])
def test_shards_are_exact(spark, n, bucket_rows):
    df = spark.range(n).repartition(7)
    rows = sharding.shuffle(df, 8, bucket_rows=bucket_rows).collect()
    assert sorted(r.id for r in rows) == list(range(n))
    whole(rows, 8)


def test_lines_of_the_matrix_follow_the_multivariate_law(spark):
    n, sizes, drawn = 6000, (4, 3, 5), 6
    counts = F.array(*[F.lit(x).cast("long") for x in sizes])
    df = spark.range(n).select(sharding.multivariate(counts, F.lit(drawn), F.lit(1), F.col("id")).alias("k"))
    got = Counter(tuple(r.k) for r in df.collect())
    chi = 0.0
    cells = [(a, b, drawn - a - b) for a in range(5) for b in range(4) if 0 <= drawn - a - b <= 5]
    for cell in cells:
        p = math.prod(math.comb(m, k) for m, k in zip(sizes, cell)) / math.comb(sum(sizes), drawn)
        chi += (got[cell] - n * p) ** 2 / (n * p)
    assert set(got) <= set(cells) and chi < len(cells) + 5 * math.sqrt(2 * len(cells))


def test_places_do_not_depend_on_where_a_row_was(spark):
    n, parts, shards = 40_000, 8, 5
    df = spark.range(0, n, 1, parts).withColumn("was", F.spark_partition_id())
    rows = sharding.shuffle(df, shards).collect()
    cells = Counter((r.was, r.shard, r.slot * 4 * shards // n) for r in rows)
    e = n / (parts * shards * 4)
    chi = sum((cells[(p, s, q)] - e) ** 2 / e for p in range(parts) for s in range(shards) for q in range(4))
    assert chi < 160 + 5 * math.sqrt(320)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.assignments(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    whole(rows, 24)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw) and r.law == "rows" and r.grown_shard is None


def test_odd_rows(spark):
    rows = [(None, None, 1, "a"), (1, "", 2, "b"), (1, "x", 3, "c"), (1, "x", 3, "c"), (2, "é" * 100_000, 4, "d")] * 11
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string")
    got = sharding.assignments(df, 4).collect()
    whole(got, 4)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len((t or "").encode()) + 8) for d, t, *_ in rows)
    assert sharding.shuffle(df, 4).columns == ["doc_id", "text", "shard", "slot"]
