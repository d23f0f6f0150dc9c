import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardwatch.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


ODD = [
    None, "", " \n\t ", "Hello, World. don't we'll 'Tis", "a b　c\x1cd\x85e f", "İ İstanbul ΣΑΣ ﬁ ① é É",
    "<|endoftext|> x<|endoftext|>y <|startoftext|>", "12345 3.14 abc123 a.b,c., ...", "日本語 テキスト 🙂🙂👍🏽 مرحبا",
    "\x00a\x01 \x7f", "UPPER lower MiXeD. ÉTÉ, straße", "word" * 3000, "x " * 9000, "'s't're", "_a_ #b $c. ..", "K Å Ω",
]


def test_ids_are_those_of_the_library(tokenizer, spark, sf_dir):
    words = packing.WordIds(PATH)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    for t in [*ODD, *texts]:
        got = np.frombuffer(words.ids((t or "").encode()), "<u4").tolist()
        assert got == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_forgetting_changes_nothing(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    words = packing.WordIds(PATH)
    t = "one two three four five one two six seven one"
    assert np.frombuffer(words.ids(t.encode()), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def check(rows, texts, tokenizer, length):
    """texts: lists of texts by doc_id."""
    by, fill = {}, {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    wanted = {}
    for d, ts in texts.items():
        for t in ts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
            wanted.setdefault((d, len(ids)), []).append(ids)
    assert set(by) == set(wanted)
    for key, lists in wanted.items():
        if len(lists) > 1 and lists[0] != lists[1]:
            continue
        ids = np.array(lists[0], "<u4")
        pieces = sorted(by[key], key=lambda r: (r.sequence_id, r.offset, r.start))
        assert sum(r.length for r in pieces) == len(lists) * key[1]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.continued == (r.start > 0) and r.continues == (r.start + r.length < key[1])
    assert sorted(fill) == list(range(len(fill)))
    for s, parts in fill.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or (s == len(fill) - 1 and at <= length)


def test_round_trip(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    rows = packing.pack(docs, PATH).collect()
    check(rows, {r.doc_id: [r.text] for r in docs.collect()}, tokenizer, packing.LENGTH)


def test_odd_rows(spark, tokenizer):
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], "y", 2), (None, "no id", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, place int").repartition(3)
    got = packing.pack(df, PATH, length=16).collect()
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(t)
    check(got, texts, tokenizer, 16)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_tokenizers_that_keep_white_space_get_whole_texts():
    text = "Two  Spaces, and\n\nlines THEN 中文 don't."
    for name, by_words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        path = public_tokenizers.path(name)
        ids = packing.WordIds(path)
        want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert ids.by_words is by_words
        assert list(memoryview(ids.ids(text.encode())).cast("I")) == want


def test_words_of_latin_letters_and_marks_are_as_the_library_gives_them():
    import random

    import numpy as np
    from public_tokenizers import path
    from tokenizers import Tokenizer

    rng = random.Random(3)
    chars = [chr(c) for c in range(0x250)] + list("'.,*#<|>  \u0301\u0307\u4e2d") * 6
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(2000)]
    texts += ["\u0130stanbul <|endoftext|> x<|endoftext|>.. a'' b''s", "\u00c9T\u00c9*** stonou$$$ na\u00efve,%", "\u01c5 \u0149 \u00df \u017f"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        whole, words = Tokenizer.from_file(path(name)), packing.WordIds(path(name))
        for text in texts:
            got = np.frombuffer(words.ids(text.encode()), "<u4").tolist()
            assert got == whole.encode(text, add_special_tokens=False).ids
