import random
import re
from collections import Counter

import pytest

from cardwatch.llm import divergence

SCHEMA = "lang string, source string, text string, term string, shard int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2) for r in rows], SCHEMA)


def plain(rows, min_docs, top=50):
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    counts, docs = {}, {}
    for lang, source, text in rows:
        found = word.findall(lower(text or ""))
        counts.setdefault(lang or "", {}).setdefault(source or "", Counter()).update(found)
        docs.setdefault(lang or "", Counter()).update(set(found))
    out = []
    for lang, by in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v, n = len(kept), {s: sum(c[t] for t in kept) for s, c in by.items()}
        p = lambda c, m: 1 + 10**9 * (c + 5) // (m + 5 * v)
        for s, own in by.items():
            pairs = [(o, sum(abs(p(own[t], n[s]) - p(c[t], n[o])) for t in kept)) for o, c in by.items() if o != s]
            all_n = sum(n.values())
            terms = [(t, p(own[t], n[s]) - p(sum(c[t] for c in by.values()), all_n)) for t in kept if own[t]]
            for part, found, most in (("pair", pairs, len(by)), ("term", [x for x in terms if x[1] > 0], top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, i, x, k) for k, (i, x) in enumerate(order, 1)]
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = ["Zürich", "été", "don't", "ÉTÉ", "a", "B", "b", "straße", "日本", "x1y", "the", " "] + [f"w{chr(97 + i % 26)}{'q' * (i // 26)}" for i in range(60)]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["s0"] * 6 + [f"s{i}" for i in range(9)] + [None])
        text = rng.choice([None, "", "12 34"]) if rng.random() < 0.1 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))
        rows.append((lang, source, text))
    return rows


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("postings, fan_in, source_block", [(10**6, None, 512), (50, 2, 3)])
def test_equals_the_definition(spark, postings, fan_in, source_block):
    rows = corpus(3)
    got = divergence.audit(frame(spark, rows).repartition(3), 8, 5, postings, fan_in, source_block)
    assert rows_of(got) == plain(rows, 8, 5)


def test_odd_tables(spark):
    assert rows_of(divergence.audit(frame(spark, []))) == []
    rows = [("en", "a", None), ("en", "b", "one two"), ("de", "c", "x " * 100_000)]
    assert rows_of(divergence.audit(frame(spark, rows))) == plain(rows, 30) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    rows += [("en", "b", "Only here")] * 30
    assert rows_of(divergence.audit(frame(spark, rows))) == plain(rows, 30)


def test_counts_beyond_64_bits_after_scaling():
    import numpy as np

    c, n = np.array([3 * 10**12, 0, 7]), np.array([5 * 10**12, 5 * 10**12, 9])
    assert divergence._shares(c, n, 3).tolist() == [1 + 10**9 * (int(a) + 5) // (int(b) + 15) for a, b in zip(c, n)]
