"""Language identification, words first.

A known word counts with its log frequency in each language. An unseen word falls back to its character
n-grams: the longest order of which any is known speaks for it, by the mean over its known n-grams. The
model is fitted on a bounded sample of labelled rows and has bounded tables; it scores whole texts in
numpy, a piece of texts at a time, so that memory follows one piece or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch.llm import wordhash
from cardwatch.llm.common import saved, unit_interval

#: Labelled rows that the fit reads, in expectation.
SAMPLE_ROWS = 20_000
#: The most frequent words, and n-grams of each order, that the model holds. They, the sample and ``LEAST_SEEN`` bound
#: the model that every task holds; an unseen word falls back to n-grams in any case.
MAX_WORDS = 200_000
MAX_GRAMS = 30_000
#: Words and n-grams that the sample has fewer times say nothing of a language yet.
LEAST_SEEN = 2
ORDERS = (4, 3, 2, 1)
#: Evidence counts as that of so many words at most, so that a score tells mixed texts from plain ones.
EVIDENCE_WORDS = 30
SMOOTHING = 0.1
UNKNOWN = "und"

_GAP = 1  # every character that is no letter
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


@dataclass
class Piece:
    """Letters of some texts as code points, other characters as gaps; words and their texts."""

    units: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray


def _read(texts: list[str]) -> Piece:
    lowered = [t.lower() for t in texts]
    units = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
    letter = _is_letter()[units]
    units = np.where(letter, units, _GAP)
    at = np.cumsum([1, *[len(t) + 1 for t in lowered]])
    begin, end = wordhash.spans(letter, at[:-1])
    return Piece(units, begin, end, np.searchsorted(begin, at), wordhash.hash_spans(units, begin, end))


def _pieces(texts: list[str]) -> Iterator[tuple[int, int, Piece]]:
    ends = np.cumsum([0, *[len(t) for t in texts]])
    for lo, hi in wordhash.pieces(ends, wordhash.PIECE_BYTES // 2):
        yield lo, hi, _read(texts[lo:hi])


def _grams(p: Piece, which: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of some words, from two letters on with the gaps at the ends; their number by word."""
    gap = int(order > 1)
    begin = p.begin[which] - gap
    counts = np.maximum(p.end[which] + gap + 1 - begin - order, 0)
    total = int(counts.sum())
    starts = np.repeat(begin - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(total)
    h = np.full(total, order, np.uint64)
    for k in range(order):
        h = wordhash.mix(h * np.uint64(31) + p.units[starts + k].astype(np.uint64))
    return h, counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lo, hi, p in _pieces(wordhash.texts(batch.column("text"))):
            per_text = np.diff(p.first)
            names = sorted(set(langs[lo:hi]))
            code = np.array([names.index(x) for x in langs[lo:hi]])
            word_lang = np.repeat(code, per_text)
            rows = []
            for order in (0, *ORDERS):
                if order:
                    h, counts = _grams(p, np.arange(len(p.begin)), order)
                    lang = np.repeat(word_lang, counts)
                else:
                    h, lang = p.hashes, word_lang
                for c, name in enumerate(names):
                    values, n = np.unique(h[lang == c], return_counts=True)
                    rows.append((order, values.astype(np.int64), name, n))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.full(len(v), o) for o, v, _, _ in rows]), pa.int32()),
                    pa.array(np.concatenate([v for _, v, _, _ in rows])),
                    pa.array([x for _, v, name, _ in rows for x in [name] * len(v)], pa.string()),
                    pa.array(np.concatenate([n for *_, n in rows]), pa.int64()),
                ],
                names=["n_gram", "hash", "lang", "n"],
            )


def training_rows(docs: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A sample of about ``sample_rows`` of the usable rows, the same ones in every run, however many rows there are."""
    n = docs.where(usable).select(F.count(F.lit(1))).first()[0]
    return docs.where(usable & in_sample(n, sample_rows))


def in_sample(n: int, sample_rows: int) -> Column:
    """Whether a doc_id is in a sample of about ``sample_rows`` of ``n``; 53 bits of its hash are compared with the share."""
    return unit_interval("doc_id") < F.lit(min(1.0, sample_rows / max(n, 1)))


@dataclass
class Model:
    """Languages, and per kind (0: words, else the order) sorted hashes with log frequencies by language."""

    langs: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]

    def look_up(self, kind: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, values = self.tables[kind]
        if not len(keys):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return keys[at] == h, at

    def score(self, texts: list[str]) -> tuple[list[str], list[float]]:
        names: list[str] = []
        scores: list[float] = []
        for _, _, p in _pieces(texts):
            per_text = np.diff(p.first)
            if not self.langs:
                names += [UNKNOWN] * len(per_text)
                scores += [0.0] * len(per_text)
                continue
            evidence = self._words(p)
            sums = np.zeros((len(evidence) + 1, len(self.langs)))
            np.cumsum(evidence, axis=0, dtype=np.float64, out=sums[1:])
            total = sums[p.first[1:]] - sums[p.first[:-1]]
            total *= np.minimum(1.0, EVIDENCE_WORDS / np.maximum(per_text, 1))[:, None]
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            share = odds / odds.sum(axis=1, keepdims=True)
            best = share.argmax(axis=1)
            empty = per_text == 0
            names += [UNKNOWN if e else self.langs[i] for i, e in zip(best.tolist(), empty.tolist())]
            scores += np.where(empty, 0.0, share[np.arange(len(best)), best]).tolist()
        return names, scores

    def _words(self, p: Piece) -> np.ndarray:
        known, at = self.look_up(0, p.hashes)
        out = np.zeros((len(at), len(self.langs)), np.float32)
        out[known] = self.tables[0][1][at[known]]
        left = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(left):
                break
            h, counts = _grams(p, left, order)
            hit, where = self.look_up(order, h)
            owner = np.repeat(np.arange(len(left)), counts)[hit]
            found = np.bincount(owner, minlength=len(left))
            values = self.tables[order][1][where[hit]]
            for c in range(len(self.langs)):
                sums = np.bincount(owner, values[:, c], minlength=len(left))
                out[left, c] = sums / np.maximum(found, 1)
            left = left[found == 0]
        return out


def fit(
    docs: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS,
    least_seen: int = LEAST_SEEN,
) -> Model:
    """Count words and n-grams of the sample on the cluster; only the bounded tables reach the driver."""
    rows = training_rows(
        docs.select("doc_id", "text", "lang"), usable & F.col("text").isNotNull() & F.col("lang").isNotNull(),
        sample_rows,
    )
    counts = saved(
        rows.select("text", "lang")
        .mapInArrow(_count, "n_gram int, hash long, lang string, n long")
        .groupBy("n_gram", "hash", "lang").agg(F.sum("n").alias("n")),
        "language-counts",
    )
    totals = {(r[0], r[1]): r[2] for r in counts.groupBy("n_gram", "lang").agg(F.sum("n")).collect()}
    langs = sorted({lang for _, lang in totals})
    tables = {}
    for kind in (0, *ORDERS):
        top = (
            counts.where(F.col("n_gram") == kind)
            .groupBy("hash").agg(
                F.sum("n").alias("all"),
                *[F.sum(F.when(F.col("lang") == x, F.col("n"))).alias(f"n{i}") for i, x in enumerate(langs)],
            )
            .where(F.col("all") >= least_seen).orderBy(F.desc("all"), "hash").limit(max_grams if kind else max_words)
            .toPandas()
        )
        keys = top["hash"].to_numpy(np.int64).astype(np.uint64)
        order = np.argsort(keys)
        n = np.stack([top[f"n{i}"].fillna(0).to_numpy(np.float64) for i in range(len(langs))], 1) if langs else None
        if n is not None:
            of = np.array([totals.get((kind, x), 0) for x in langs], float)
            n = np.log((n + SMOOTHING) / (of + SMOOTHING * max(len(keys), 1)))[order].astype(np.float32)
        tables[kind] = (keys[order], n)
    return Model(langs, tables)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` appended; only the text is read for them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.score(wordhash.texts(batch.column(columns.index("text"))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*columns, "__lang", "__score"],
            )

    schema = T.StructType(
        [*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    )
    return docs.mapInArrow(label, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from text and language of rows that are not held out and have an id. A null text or one without a
    letter is ``und`` with score 0; so is all if no row can be learned from. Letters of which nothing is
    known give the first language with an even score; ties go to the first language by name. Repeated rows
    are scored each, an empty table gives no rows, other columns are ignored.
    """
    model = fit(docs, _usable(), sample_rows)
    narrow = docs.select("doc_id", "text")
    return predict(narrow, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
    )


def _usable() -> Column:
    return F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))


def accepted(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with ``min_score`` or more; all columns stay.

    Null, empty and letterless texts go. Repeated rows stay or go together, a tie between languages goes to the first by
    name and scores as it is. Without a row to learn from, all go; an empty table stays empty. Further columns, whatever
    their names, are kept as they are.
    """
    model = fit(docs, _usable())
    scored = predict(docs, model)
    return scored.where((F.col("__lang") != UNKNOWN) & (F.col("__score") >= min_score)).select(*docs.columns)
