import re

import pytest

from cardwatch.llm import quality_rules, sql
from tests.compare import connect, differences
from tests.llm.brute import WORD


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            r, n < 20 or 100 * r > 30 * n)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts_on_odd_texts(spark):
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    texts = [
        None, "", " \n\t", "a", "a\n\na\n a\nb\x0b\nb\x0b", "a b c d e f g h a b c d e f g h", "x " * 40,
        "a b c d e f g h i " * 3 + "tail", "é ü %$ 🙂🙂 <|>", long, "a b c d e f g h " + "q " + "a b c d e f g h",
    ]
    rows = [(i, t, None, "s", 1) for i, t in enumerate([*texts, texts[-1]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in quality_rules.verdicts(df).collect()}
    assert got == {i: base(t) for i, t, *_ in rows}
    assert quality_rules.accepted(df).columns == df.columns


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_rules.verdicts(df).collect() == []


def test_limits_follow_the_group_and_fall_back(spark):
    plain = " ".join(["alpha", "beta", "gamma", "delta"] * 2 + [f"w{i}" for i in range(20)])
    rows = [(i, plain + f" n{i}", "en", "big") for i in range(250)]
    rows += [(1000 + i, plain + " ### ### ### $$$" * (i % 2), "en", "odd") for i in range(4)]
    rows += [(2000 + i, "#### " + plain.replace(" ", " # ") + f" n{i}", "xx", "symbols") for i in range(250)]
    rows += [(3000, "junk " + "%%%%%%%% " * 20 + plain, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality_rules.verdicts(df).where("kept").collect()}
    assert kept >= set(range(250)) and kept >= set(range(2000, 2250))  # usual there, so accepted there
    assert {1000, 1002} <= kept and not kept & {1001, 1003, 3000}


def test_buckets_are_within_one_in_32(spark):
    df = spark.range(1000).selectExpr("id * 37 as v")
    worst = df.select(quality_rules.bucket(df.v).alias("b"), "v").where("v - b > v / 32").count()
    assert worst == 0


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf_dir, name):
    folder = sf_dir.replace("sf0.001", name)
    got = quality_rules.verdicts(spark.read.parquet(f"{folder}/documents.parquet"))
    with connect(folder) as con:
        assert differences(got, con, sql.OP7) == []


def test_limits_move_smoothly_with_the_size_of_a_group(spark):
    """A source unlike its language, of 1 to 400 documents beside 2 000 plain ones of another source."""
    sizes = [1, 5, 10, 16, 17, 25, 40, 80, 150, 199, 200, 201, 400]
    rows = [(f"l{n}", s, "symbol_share", b, c) for n in sizes for s, b, c in (("plain", 0, 1000), ("plain", 4, 1000))]
    rows += [(f"l{n}", "odd", "symbol_share", 96 + 2 * (k % 4), 1) for n in sizes for k in range(n)]
    histogram = spark.createDataFrame(rows, "lang string, source string, metric string, bucket long, n long").groupBy(
        "lang", "source", "metric", "bucket").sum("n").withColumnRenamed("sum(n)", "n")
    most = {r.lang: r["__limits"]["symbol_share"]["most"] for r in quality_rules.limits(histogram).where("source = 'odd'").collect()}
    assert most["l199"] == most["l200"] == most["l201"] and most["l1"] < 96 < most["l25"]
    kept = [sum(96 + 2 * (k % 4) <= most[f"l{n}"] for k in range(n)) for n in sizes]
    assert kept == [0 if n <= 16 else n for n in sizes]  # from a quarter of the weight on the source speaks for itself
