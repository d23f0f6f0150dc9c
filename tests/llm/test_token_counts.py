import random

import public_tokenizers
import pytest
import sentencepiece

from cardwatch.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH)


ODD = [
    "", " ", "  ", "   a  b ", "\n", "\n\n a\n", "a \n b", "▁x ▁", "<s>x</s> <0x0A> <unk>", "\x00a\x01", "日本語テキスト 漢字",
    "🙂👍🏽 é ﬁ①Ａ　x y", "a\tb\r\nc", "www.example.com/path?x=1&y=2", "x" * 500, "ab" * 300, " " * 100,
    "a" + " " * 37 + "b", "==========----------......", "1234567890" * 9, "▁" * 20 + "a", "Ünïcödé ß ñ", "\n " * 9,
]


def noise(rng):
    pools = ["abcdefghij ", "aeiou t\n", " \n▁", "0123456789.,", "éüßñ çà", "日本語の漢字 ", "thernd ing tion", "\t\x00😀 é"]
    return "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(120)))


def test_counts_are_those_of_the_library(model, counter, spark, sf_dir):
    rng = random.Random(1)
    texts = ODD + [noise(rng) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for t in texts:
        assert counter.count(t) == len(model.encode(t)), repr(t)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50])
def test_chunk_maps_compose_to_the_same(model, counter, chunk):
    rng = random.Random(chunk)
    for t in ODD + [noise(rng) for _ in range(400)]:
        assert counter.count(t, chunk) == len(model.encode(t)), repr(t)


def test_composition_is_associative(counter):
    rng = random.Random(9)
    for _ in range(300):
        a, b, c = (counter.chunk(noise(rng)) for _ in range(3))
        assert counter.compose(counter.compose(a, b), c) == counter.compose(a, counter.compose(b, c))


def test_starting_anew_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 20)
    monkeypatch.setattr(token_counts, "MAX_WORDS", 3)
    own = token_counts.Counter(PATH)
    rng = random.Random(4)
    for t in ODD + [noise(rng) for _ in range(100)]:
        assert own.count(t) == len(model.encode(t))


def test_documents(spark, model):
    long = "the cat sat. " * 60_000
    rows = [(i, t) for i, t in enumerate([*ODD, long, None])] + [(3, ODD[3]), (None, "no id")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int").repartition(3)
    got = token_counts.token_counts(df, PATH)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = []
    for d, t in rows:
        n = len(model.encode(t or ""))
        expected.append((d, len((t or "").encode()), n, n > 4096))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    assert token_counts.token_counts(df.where("false"), PATH).collect() == []
