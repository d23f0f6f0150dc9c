import itertools
import random

from cardwatch.llm import decontamination as d
from cardwatch.llm import sql
from tests.compare import connect, differences

DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def ids(df):
    return sorted(((r.doc_id, r.item_id) for r in df.collect()), key=str)


def test_masks_hit_every_window_with_two_substitutions():
    for bad in itertools.combinations(range(13), 2):
        assert any(
            not any(at + o in bad for o in mask) for mask in d.MASKS for at in range(13 - d.SPAN + 1)
        )


def test_substitutions_and_near_misses(spark):
    rng = random.Random(3)
    item = [f"b{i}" for i in range(30)]
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    docs, expected = [], []
    for i in range(60):
        part = item[rng.randrange(17) :][:13]
        changes = i % 5
        for at in rng.sample(range(13), changes):
            part[at] = "changed"
        docs.append((i, " ".join(noise(rng.randrange(20)) + part + noise(rng.randrange(20)))))
        if changes <= 2:
            expected.append((i, 7))
    short = [(100, "one two three four five six seven eight nine"), (101, "One, two. THREE four five six seven-eight"),
             (102, "one two three four five six seven ate"), (103, "one two three four five six sept ate")]
    bench = [(7, " ".join(item)), (9, " ".join(item).upper()), (8, "one two three four five six seven eight"),
             (5, "tiny item"), (4, None), (3, "")]
    df = spark.createDataFrame([(*r, 1) for r in docs + short + [(200, None), (201, ""), (None, docs[0][1]), docs[0]]],
                               DOCS + ", item_id int")
    got = d.leaks(df, spark.createDataFrame([(*r, 2) for r in bench], BENCH + ", doc_id int"))
    assert ids(got) == sorted([*expected, (100, 8), (101, 8), (102, 8), (None, 7)], key=str)
    kept = d.clean(df, spark.createDataFrame(bench, BENCH))
    assert kept.columns == df.columns
    gone = {i for i, _ in expected} | {100, 101, 102, None}
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in docs + short} - gone | {200, 201}


def test_rows_that_repeat_an_id_are_judged_by_their_text(spark):
    item = " ".join(f"b{i}" for i in range(15))
    df = spark.createDataFrame([(1, item), (1, "clean text of its own"), (2, item + " " + "x " * 30_000 + item)], DOCS)
    bench = spark.createDataFrame([(1, item)], BENCH)
    assert ids(d.leaks(df, bench)) == [(1, 1), (2, 1)]
    assert [tuple(r) for r in d.clean(df, bench).collect()] == [(1, "clean text of its own")]


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], BENCH)
    assert d.leaks(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b c")], DOCS)
    assert d.clean(one, bench).count() == 1


def test_joins_shuffle_beyond_the_bound(spark, sf_dir, monkeypatch):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    before = ids(d.leaks(docs, bench))
    monkeypatch.setattr(d, "BROADCAST_ROWS", 0)
    assert ids(d.leaks(docs, bench)) == before and before


def test_equals_sql(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, bench = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "benchmark"))
    with connect(folder) as con:
        assert differences(d.leaks(docs, bench).drop("text_hash"), con, sql.OP5) == []


def test_short_items_and_unspaced_scripts(spark):
    """Against the definition: the best alignment of all words."""
    rng = random.Random(8)
    letters = [f"q{i}" for i in range(12)]
    bench = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in range(1, 13)] + [(50, "机器学习是一门人工智能的科学"), (51, "天地"), (52, "")]
    docs = []
    for n in range(1, 13):
        words = bench[n - 1][1].split()
        for changes in (0, 1, 2):
            part = list(words)
            for at in rng.sample(range(n), min(changes, n)):
                part[at] = rng.choice(letters)
            around = lambda: [rng.choice(letters) for _ in range(rng.randrange(1, 6))]
            docs.append((len(docs), " ".join(around() + part + around())))
            docs.append((len(docs), " ".join(part)))
    docs += [(900, "前面机器学习是一门人工智能的科学后面"), (901, "机器学习是一门人工智能的技学"), (902, "天地"), (903, "天地玄黄"), (904, "机器")]
    df = spark.createDataFrame([(*r, True, 1, 2, 3) for r in docs], DOCS + ", hit boolean, seed int, w int, shift int")
    cut = lambda t: [w for part in t.split() for w in (part if part[0] > "\u3000" else [part])]

    def holds(text, item):
        t, n = cut(text), len(item)
        best = max((sum(0 <= k + s < len(t) and t[k + s] == x for k, x in enumerate(item)) for s in range(-n, len(t))), default=0)
        if n >= 13:
            return any(sum(a == b for a, b in zip(t[s + o :], item[o : o + 13])) >= 11 for o in range(n - 12) for s in range(len(t)))
        return bool(n) and (best >= n - 1 if n >= 8 else best == n and (n >= 4 or len(t) == n))

    expected = [(i, b) for i, t in docs for b, item in bench if holds(t, cut(item))]
    assert ids(d.leaks(df, spark.createDataFrame(bench, BENCH))) == sorted(expected, key=str)
    assert {r.doc_id for r in d.clean(df, spark.createDataFrame(bench, BENCH)).collect()} == {i for i, _ in docs} - {i for i, _ in expected}


def test_sql_holds_short_items_too(spark, tmp_path):
    bench = [(1, "a b c d e f g"), (2, "p q r s t u v w x y"), (3, "solo"), (4, "天地玄黄宇宙")]
    docs = [(1, "x a b c d e f g y"), (2, "p q r s t u v w x z"), (3, "solo"), (4, "solo act"), (5, "说天地玄黄宇宙"), (6, None)]
    frames = {"documents": spark.createDataFrame(docs, DOCS), "benchmark": spark.createDataFrame(bench, BENCH)}
    for name, df in frames.items():
        df.toPandas().to_parquet(f"{tmp_path}/{name}.parquet")
    got = d.leaks(frames["documents"], frames["benchmark"])
    assert ids(got) == [(1, 1), (2, 2), (3, 3), (5, 4)]
    with connect(str(tmp_path)) as con:
        assert differences(got.drop("text_hash"), con, sql.OP5) == []
