"""Toxicity by a factorization machine over hashed terms.

Terms are words and their prefixes of four to six letters, hashed into a table of fixed size. A term counts as
``x = log(1 + occurrences)``, and the logit of a text is

    b + sum(w x) + (|sum(v x)|**2 - sum(|v x|**2)) / 2

so pairs of terms, such as an insult and whom it is aimed at, count beyond what each counts by itself. The fit reads a
bounded sample of labelled rows, keeps the terms that tell the classes apart, in either direction, by themselves or
beside another term (others would only be learned by heart), and runs AdaGrad on them. Whole texts are scored in numpy, a piece of texts at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import language_id, wordhash
from cardwatch.llm.common import saved, small_or_shuffled, unit_interval

BITS = 18
FACTORS = 4
PREFIXES = (4, 5, 6)
#: Labelled rows that the fit reads, in expectation, half of them toxic where there are enough.
SAMPLE_ROWS = 6_000
THRESHOLD = 0.7
#: A term is kept if its shares of toxic and of other rows lie so many standard errors apart, in so many rows.
MIN_Z = 4.0
MIN_ROWS = 5
#: So many standard errors for both terms of a pair; pairs are counted in blocks of so many terms.
PAIR_Z = 5.0
PAIR_BLOCK = 1024
EPOCHS = 30
BATCH = 128
RATE = 0.1
PENALTY = 1e-3


def _terms(p: language_id.Piece) -> list[np.ndarray]:
    """Slots of the words' terms, kind by kind; -1 where a word is too short for a prefix."""
    found = [p.hashes]
    for k in PREFIXES:
        long = p.end - p.begin > k
        h = wordhash.hash_spans(p.units, p.begin, np.minimum(p.begin + k, p.end))
        found.append(np.where(long, wordhash.mix(h + np.uint64(k)), np.uint64(0)))
    shift = np.uint64(64 - BITS)
    return [
        (h >> shift).astype(np.int32) if i == 0 else np.where(h == 0, -1, (h >> shift).astype(np.int32))
        for i, h in enumerate(found)
    ]


@dataclass
class Machine:
    """Bias, kept slots, their weights and factors; without slots every text scores alike."""

    bias: float
    slots: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, row: np.ndarray, term: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
        """Of ``rows`` texts from entries (text, kept term, value)."""
        vx = self.factors[term] * x[:, None]
        sums = np.stack([np.bincount(row, vx[:, k], rows) for k in range(vx.shape[1])], 1)
        pairs = (sums**2).sum(1) - np.bincount(row, (vx**2).sum(1), rows)
        return self.bias + np.bincount(row, self.weights[term] * x, rows) + pairs / 2

    def score(self, texts: list[str]) -> list[float]:
        out: list[float] = []
        kept = np.full((1 << BITS) + 1, -1, np.int64)  # the last entry is for slot -1
        kept[self.slots] = np.arange(len(self.slots))
        for lo, hi, p in language_id._pieces(texts):
            text_of = np.repeat(np.arange(hi - lo), np.diff(p.first))
            found = []
            for slots in _terms(p):
                term = kept[slots]
                hit = term >= 0
                found.append(text_of[hit] * max(len(self.slots), 1) + term[hit])
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            row, term = np.divmod(keys, max(len(self.slots), 1))
            out += _sigmoid(self.logits(row, term, np.log1p(n), hi - lo)).tolist()
        return out


def _sigmoid(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("toxic")
        for lo, hi, p in language_id._pieces(wordhash.texts(batch.column("text"))):
            slots = np.stack(_terms(p), axis=1)
            packed, counts = [], []
            for a, z in zip(p.first[:-1].tolist(), p.first[1:].tolist()):
                own = slots[a:z].ravel()
                values, n = np.unique(own[own >= 0], return_counts=True)
                packed.append(values.astype("<i4").tobytes())
                counts.append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), pa.array(counts, pa.binary()), labels.slice(lo, hi - lo)],
                names=["slots", "counts", "toxic"],
            )


def _telling(slots: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Slots that one class holds clearly more often than the other, and those of pairs that tell beyond their terms."""
    size, toxic = 1 << BITS, labels == 1
    with_1 = sum((np.bincount(s, minlength=size) for s, t in zip(slots, toxic) if t), np.zeros(size))
    with_0 = sum((np.bincount(s, minlength=size) for s, t in zip(slots, toxic) if not t), np.zeros(size))
    n1, n0 = toxic.sum(), (~toxic).sum()
    share = (with_1 + with_0) / (n1 + n0)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    alone = (np.abs(with_1 / n1 - with_0 / n0) / error >= MIN_Z) & (with_1 + with_0 >= MIN_ROWS)
    return np.union1d(np.flatnonzero(alone), _telling_pairs(slots, toxic, with_1, with_0))


def _telling_pairs(slots: list[np.ndarray], toxic: np.ndarray, with_1: np.ndarray, with_0: np.ndarray) -> np.ndarray:
    """Slots of pairs in which each term, among the rows with the other, shifts the share of toxic ones clearly.

    In ``n`` rows a difference is at most ``sqrt(n)`` standard errors, so no pair of rarer terms could pass.
    """
    often = np.flatnonzero((with_1 + with_0 >= PAIR_Z**2) & (with_1 > 0) & (with_0 > 0))
    place = np.full(1 << BITS, -1)
    place[often] = np.arange(len(often))
    rows = np.argsort(~toxic, kind="stable")
    n1 = int(toxic.sum())
    term = place[np.concatenate([slots[i] for i in rows])]
    row = np.repeat(np.arange(len(rows)), [len(slots[i]) for i in rows])[term >= 0]
    term = term[term >= 0]
    order = np.argsort(term, kind="stable")
    term, row = term[order], row[order]
    starts = list(range(0, len(often), PAIR_BLOCK))

    def dense(lo: int) -> np.ndarray:
        a, z = np.searchsorted(term, (lo, lo + PAIR_BLOCK))
        block = np.zeros((len(rows), min(PAIR_BLOCK, len(often) - lo)), np.float32)
        block[row[a:z], term[a:z] - lo] = 1
        return block

    def shift(k1: np.ndarray, k0: np.ndarray, n1: np.ndarray, n0: np.ndarray) -> np.ndarray:
        """Standard errors between the shares of k1 in n1 and of k0 in n0 rows."""
        k, n = k1 + k0, n1 + n0
        return np.abs(k1 * n0 - k0 * n1) / np.sqrt(np.maximum(k * (n - k) * (n1 * n0 / n), 1e-6))

    found = np.zeros(len(often), bool)
    w1, w0 = with_1[often], with_0[often]
    for i in starts:
        x = dense(i)
        a = slice(i, i + PAIR_BLOCK)
        for j in starts[i // PAIR_BLOCK :]:
            y = x if i == j else dense(j)
            b = slice(j, j + PAIR_BLOCK)
            k1, k0 = (x[:n1].T @ y[:n1]).astype(float), (x[n1:].T @ y[n1:]).astype(float)
            tells = shift(k1, k0, w1[a, None], w0[a, None]) >= PAIR_Z
            tells &= shift(k1, k0, w1[None, b], w0[None, b]) >= PAIR_Z
            found[a] |= tells.any(1)
            found[b] |= tells.any(0)
    return often[found]


def train(slots: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Machine:
    """AdaGrad on the logistic loss over the telling terms; both classes weigh the same in total."""
    toxic = float(labels.mean()) if len(labels) else 0.0
    if not 0 < toxic < 1:
        nothing = np.zeros(0, np.int64)
        return Machine(3.0 if toxic == 1 else -3.0, nothing, np.zeros(0), np.zeros((0, FACTORS)))
    kept = _telling(slots, labels)
    place = np.full(1 << BITS, -1)
    place[kept] = np.arange(len(kept))
    terms, values = [], []
    for s, n in zip(slots, counts):
        at = place[s]
        terms.append(at[at >= 0])
        values.append(np.log1p(n[at >= 0]))
    lengths = np.array([len(t) for t in terms])
    rng = np.random.default_rng(seed)
    m = Machine(0.0, kept, np.zeros(len(kept)), rng.normal(0, 0.05, (len(kept), FACTORS)))
    g_w, g_v, g_b = np.full(len(kept), 1e-6), np.full((len(kept), FACTORS), 1e-6), 1e-6
    weight = np.where(labels == 1, 0.5 / toxic, 0.5 / (1 - toxic))
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            term = np.concatenate([terms[i] for i in rows])
            x = np.concatenate([values[i] for i in rows])
            row = np.repeat(np.arange(len(rows)), lengths[rows])
            error = (_sigmoid(m.logits(row, term, x, len(rows))) - labels[rows]) * weight[rows] / len(rows)
            ex = error[row] * x
            step = np.bincount(term, ex, len(kept)) + PENALTY * m.weights
            vx = m.factors[term] * x[:, None]
            sums = np.stack([np.bincount(row, vx[:, k], len(rows)) for k in range(FACTORS)], 1)
            turn = np.stack(
                [np.bincount(term, ex * (sums[row, k] - vx[:, k]), len(kept)) for k in range(FACTORS)], 1
            ) + PENALTY * m.factors
            g_w += step**2
            g_v += turn**2
            g_b += error.sum() ** 2
            m.weights -= RATE * step / np.sqrt(g_w)
            m.factors -= 0.3 * RATE * turn / np.sqrt(g_v)
            m.bias -= float(RATE * error.sum() / np.sqrt(g_b))
    return m


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on a sample of the labelled rows that are not held out; it alone reaches the driver, as slots."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # a document once
    n = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(0.0)
    for value in (0, 1):
        share = F.when(F.col("toxic") == value, min(1.0, sample_rows / 2 / max(n.get(value, 0), 1))).otherwise(share)
    chosen = known.where(unit_interval("doc_id") < share)
    # Twice the expected number at most is broadcast, so that no text moves but those of the sample.
    chosen = small_or_shuffled(saved(chosen, "toxic-ids"), 2 * sample_rows)
    rows = saved(
        docs.select("doc_id", "text").join(chosen, "doc_id")
        # One text for an id, however many rows repeat it.
        .groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("one")).select("one.*")
        .mapInArrow(_features, "slots binary, counts binary, toxic int"),
        "toxic-sample",
    ).toArrow()
    read = lambda name: [np.frombuffer(x.as_py(), "<i4") for x in rows.column(name)]
    slots, counts = read("slots"), read("counts")
    toxic = np.array(rows.column("toxic").to_pylist(), float)
    order = sorted(range(len(slots)), key=lambda i: (slots[i].tobytes(), toxic[i]))  # whatever order they came in
    return train([slots[i] for i in order], [counts[i] for i in order], toxic[order])


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labelled rows that are not held out and have an id; a label repeated for an id counts once, as
    toxic if any of them is. A null or empty text, or one without letters, gets the score of no terms. With labels
    of one class only, or none, every text scores alike. Repeated rows are scored each, an empty table gives no
    rows, other columns are ignored.
    """
    machine = fit(docs, labels, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(wordhash.texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
