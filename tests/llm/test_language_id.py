import zlib

import numpy as np

from cardwatch.llm import language_id

SCHEMA = "doc_id long, text string, lang string"


def test_words_and_grams_by_hand():
    p = language_id._read(["Ab, ÇA1x", "", "ß"])
    assert len(p.begin) == 4 and np.diff(p.first).tolist() == [3, 0, 1]
    q = language_id._read(["ab", "ça x ß"])
    assert p.hashes.tolist() == q.hashes.tolist()
    h, n = language_id._grams(p, np.arange(4), 3)
    assert n.tolist() == [2, 2, 1, 1]
    assert h[4] == language_id._grams(language_id._read(["x"]), np.arange(1), 3)[0][0]


def brute(model, text):
    """The definition, word by word."""
    total, words, run = np.zeros(len(model.langs)), 0, []
    for c in text.lower() + "\n":
        if c.isalpha():
            run.append(c)
            continue
        if not run:
            continue
        p = language_id._read(["".join(run)])
        known, at = model.look_up(0, p.hashes)
        if known[0]:
            total += model.tables[0][1][at[0]]
        else:
            for order in language_id.ORDERS:
                h, _ = language_id._grams(p, np.arange(1), order)
                hit, where = model.look_up(order, h)
                if hit.any():
                    total += model.tables[order][1][where[hit]].mean(axis=0)
                    break
        words, run = words + 1, []
    total *= min(1.0, language_id.EVIDENCE_WORDS / max(words, 1))
    share = np.exp(total - total.max())
    share /= share.sum()
    return (model.langs[int(share.argmax())], share.max()) if words else ("und", 0.0)


def test_held_out_accuracy_and_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language_id.languages(docs).join(docs, "doc_id").collect()
    out = [r for r in rows if r.held_out and r.lang]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    model = language_id.fit(docs, language_id._usable())
    for r in rows[:40]:
        name, score = brute(model, r.text)
        assert name == r.lang_pred and abs(score - r.score) < 1e-3


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    turned = docs.withColumn(
        "lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))
    )
    a, b = (sorted(map(tuple, language_id.languages(d).collect())) for d in (docs, turned))
    assert a == b


def test_odd_rows(spark):
    train = [(i, "the cat and the dog " * 3, "en") for i in range(40)]
    train += [(100 + i, "le chat et le chien " * 3, "fr") for i in range(40)]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "123 !? \n", "en"), (1003, "привет мир", None),
           (1004, "THE dogs", None), (None, "chats", "fr"), (1005, "the cat " * 50_000, None), (1004, "THE dogs", None)]
    df = spark.createDataFrame([(*r, 1) for r in train + odd], SCHEMA + ", lang_pred int")
    got = [(r.doc_id, r.lang_pred, r.score) for r in language_id.languages(df).collect()]
    by = {d: (x, s) for d, x, s in got}
    assert len(got) == len(train + odd)
    assert by[1000] == by[1001] == by[1002] == ("und", 0.0)
    assert by[1003] == ("en", 0.5) and by[1004][0] == "en" and by[None][0] == "fr" and by[1005][0] == "en"
    assert all(0 <= s <= 1 for _, _, s in got)
    kept = language_id.accepted(df)
    assert kept.columns == df.columns and {1000, 1001, 1002}.isdisjoint({r.doc_id for r in kept.collect()})


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language_id.languages(empty).collect() == []
    rows = spark.createDataFrame([(1, "a b", None), (3, "c", None)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language_id.languages(rows).collect()} == {("und", 0.0)}


def test_invalid_bytes_do_not_stop_it(spark):
    df = spark.sql("SELECT 1L AS doc_id, CAST(X'61FF62' AS STRING) AS text, 'en' AS lang")
    assert len(language_id.languages(df).collect()) == 1


def test_samples_of_huge_tables_are_not_empty(spark):
    """The rule for a table of 10^11 rows takes its share of 2 * 10^7 of them."""
    from cardwatch.llm import language_id

    rows = spark.range(20_000_000).withColumnRenamed("id", "doc_id")
    got = rows.where(language_id.in_sample(10**11, 50_000_000)).count()
    assert 9_500 < got < 10_500
    assert rows.limit(1000).where(language_id.in_sample(1000, 20_000)).count() == 1000
