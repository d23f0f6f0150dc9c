import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from cardwatch.llm import language_id, toxicity

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def brute(m, text):
    """The formula, term by term and pair by pair."""
    counts = {}
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        for slots in toxicity._terms(language_id._read([word])):
            at = np.flatnonzero(m.slots == slots[0])
            if slots[0] >= 0 and len(at):
                counts[int(at[0])] = counts.get(int(at[0]), 0) + 1
    x = {t: math.log1p(n) for t, n in counts.items()}
    z = m.bias + sum(m.weights[t] * v for t, v in x.items())
    terms = sorted(x)
    z += sum(
        float(m.factors[a] @ m.factors[b]) * x[a] * x[b] for i, a in enumerate(terms) for b in terms[:i]
    )
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def both(spark, sf_dir, name="sf0.1"):
    folder = sf_dir.replace("sf0.001", name)
    return (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))


def test_held_out_documents(spark, sf_dir):
    docs, labels = both(spark, sf_dir)
    got = toxicity.toxicity(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert caught >= 0.85 and wrong <= 0.01
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_scores_follow_the_formula(spark, sf_dir):
    docs, labels = both(spark, sf_dir, "sf0.01")
    m = toxicity.fit(docs, labels)
    texts = [r.text for r in docs.limit(60).collect()] + ["", "idiot", "Idiot moron, MORON idiot x1"]
    for t, s in zip(texts, m.score(texts)):
        assert abs(s - brute(m, t)) < 1e-9


def test_pairs_count_beyond_their_terms():
    rng = np.random.default_rng(0)
    words = ["insult", "group", "insult group", "weather"]
    texts = [words[i % 4] + f" filler{rng.integers(9)}" for i in range(800)]
    labels = np.array([float(i % 4 == 2) for i in range(800)])
    slots, counts = [], []
    for t in texts:
        s = np.stack(toxicity._terms(language_id._read([t])), 1).ravel()
        v, n = np.unique(s[s >= 0], return_counts=True)
        slots.append(v)
        counts.append(n)
    one, other, pair = toxicity.train(slots, counts, labels).score(words[:3])
    assert pair > 0.7 and one < 0.5 and other < 0.5


def sample_of(texts):
    slots, counts = [], []
    for t in texts:
        s = np.stack(toxicity._terms(language_id._read([t])), 1).ravel()
        v, n = np.unique(s[s >= 0], return_counts=True)
        slots.append(v)
        counts.append(n)
    return slots, counts


def test_pairs_of_terms_that_tell_nothing_alone():
    rng = np.random.default_rng(0)
    words = ["alpha delta", "bravo gamma", "alpha gamma", "bravo delta"]  # every word in half of either class
    texts = [words[i % 4] + f" filler{rng.integers(9)}" for i in range(800)]
    m = toxicity.train(*sample_of(texts), np.array([float(i % 4 < 2) for i in range(800)]))
    a, b, c, d = m.score(words)
    assert min(a, b) > 0.7 and max(c, d) < 0.3


def test_terms_for_clean_lower_the_score():
    texts = ["insult", "insult quoted", "weather", "weather quoted"] * 200
    m = toxicity.train(*sample_of(texts), np.array([1.0, 0.0, 0.0, 0.0] * 200))
    said, quoted = m.score(["insult", "insult quoted"])
    assert said > 0.7 and quoted < 0.5


def test_labels_of_held_out_rows_are_not_used(spark, sf_dir):
    docs, labels = both(spark, sf_dir, "sf0.01")
    turned = labels.withColumn(
        "toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    docs = [(i, ("you vile brute" if i % 2 else "good day to all") + " " + "word " * (i % 5)) for i in range(300)]
    labels = [(i, i % 2) for i in range(300)] + [(1, 0), (None, 1), (7, None)]
    odd = [(1000, None), (1001, ""), (1002, "123 %%%"), (None, "vile brute"), (1003, "vile brute " * 40_000),
           (1, docs[1][1]), (1, docs[1][1])]
    df = spark.createDataFrame([(*r, 0) for r in docs + odd], DOCS + ", toxic int")
    lb = spark.createDataFrame([(*r, "x") for r in labels], LABELS + ", text string")
    got = toxicity.toxicity(df, lb).collect()
    assert len(got) == len(docs) + len(odd)
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == by[1003].predicted == by[1].predicted == 1 and by[None].held_out is False
    assert by[1000].score == by[1001].score == by[1002].score < 0.7


def test_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], DOCS)
    none, clean = spark.createDataFrame([], LABELS), spark.createDataFrame([(1, 0), (2, 0), (3, 0)], LABELS)
    for labels in (none, clean):
        assert {r.predicted for r in toxicity.toxicity(docs, labels).collect()} == {0}
    assert toxicity.toxicity(docs.where("false"), none).collect() == []
