"""How the sources of a language differ in their words: single-pass in-memory indexing.

1. A task reads its texts once and indexes them in memory: per language and source how often each term occurs, and in
   how many texts of the language. When the block is full, it is spilled as a run: per hash shard the terms in order,
   each with its postings (source, count).
2. Runs are written to the shared folder. A merge task holds the slices of at most ``fan_in`` runs of one shard, merges
   them by a heap and adds up equal terms; it writes a longer run. Merges repeat until one run a shard is left, so no
   task sees more than a slice, however many runs there are or however frequent a term is.
3. Terms in too few texts go. What is left, a row per language and term, gives the size of each vocabulary and the
   number of its occurrences in each source, and so every smoothed share.
4. Shares of terms that two sources both lack differ by one constant, so a pair starts from that constant times the size of
   the vocabulary. The terms are streamed once more, shard by shard, and correct only the pairs that one of their
   sources is part of; a task adds its corrections up before it hands them on.

Everything is whole numbers, so the order of sums does not matter.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import groupby, repeat
from operator import itemgetter, ne

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwatch.llm.common import discard, saved, shuffle_width, small_or_shuffled

#: Bytes of runs of A-Z, a-z and all of UTF-8 beyond ASCII, after A-Z were lower-cased.
TERM = re.compile(rb"[a-z\x80-\xff]+")
MIN_DOCS = 30
TOP = 50
#: Added to every count, and the scale of the shares.
SMOOTH, SCALE = 5, 1_000_000_000
#: Postings that a block holds; some 100 bytes each.
BLOCK_POSTINGS = 400_000
#: Sources of a language that one task compares with as many others.
SOURCE_BLOCK = 512
#: Sources (over all languages) that are broadcast at most; more are joined by a shuffle.
BROADCAST_GROUPS = 100_000

RUN = ("run string, shard int, lang string, names array<string>, terms array<binary>, docs array<bigint>, "
       "heads array<int>, whom array<int>, counts array<bigint>")
KEPT = "lang string, shard int, term string, sources array<string>, counts array<bigint>"


class Block:
    """The index of the texts since the last spill: per language the texts of each term, per source its occurrences."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = TERM.findall(text.lower())
        own = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        self.size -= len(own)
        own.update(terms)
        self.size += len(own)
        self.docs.setdefault(lang, Counter()).update(set(terms))

    def run(self, name: str, shards: int) -> Iterator[pa.RecordBatch]:
        """Rows of terms in order, by language and shard; the first shard names all sources, also those without terms."""
        for lang, docs in self.docs.items():
            order = sorted(docs)
            home = np.array([zlib.crc32(t) % shards for t in order], np.int64)
            by_shard = np.argsort(home, kind="stable")
            terms = [order[k] for k in by_shard.tolist()]
            place = dict(zip(terms, range(len(terms))))
            names = sorted(self.counts[lang])
            at, whom, counts = [], [], []
            for k, source in enumerate(names):
                own = self.counts[lang][source]
                at.append(np.fromiter(map(place.__getitem__, own.keys()), np.int64, len(own)))
                whom.append(np.full(len(own), k, np.int32))
                counts.append(np.fromiter(own.values(), np.int64, len(own)))
            at = np.concatenate(at)
            sort = np.argsort(at, kind="stable")
            heads = np.append(0, np.cumsum(np.bincount(at, minlength=len(terms))))
            whole = Slice(names, terms, np.fromiter(map(docs.__getitem__, terms), np.int64, len(terms)), heads,
                          np.concatenate(whom)[sort], np.concatenate(counts)[sort])
            cuts = np.searchsorted(home[by_shard], np.arange(shards + 1))
            for shard, (lo, hi) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                if hi > lo or shard == 0:
                    yield _run_batch(name, shard, lang, whole.part(lo, hi, all_names=shard == 0))


class Slice:
    """Terms in order, each with its texts and its postings: those of term k lie from heads[k] to heads[k + 1]."""

    def __init__(self, names: list[str], terms: list[bytes], docs, heads, whom, counts) -> None:
        self.names, self.terms, self.docs, self.heads, self.whom, self.counts = names, terms, docs, heads, whom, counts

    def part(self, lo: int, hi: int, all_names: bool) -> Slice:
        a, z = int(self.heads[lo]), int(self.heads[hi])
        names, whom = self.names, self.whom[a:z]
        if not all_names:
            used, whom = np.unique(whom, return_inverse=True)
            names = [names[k] for k in used.tolist()]
        return Slice(names, self.terms[lo:hi], self.docs[lo:hi], self.heads[lo : hi + 1] - a, whom, self.counts[a:z])


def _run_batch(name: str, shard: int, lang: str, s: Slice) -> pa.RecordBatch:
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([shard], pa.int32()), pa.array([lang]), one(s.names, pa.string()), one(s.terms, pa.binary()),
         one(s.docs, pa.int64()), one(s.heads.astype(np.int32), pa.int32()), one(s.whom.astype(np.int32), pa.int32()),
         one(s.counts, pa.int64())],
        names=[c.split()[0] for c in RUN.split(", ")],
    )


def _index(batches: Iterator[pa.RecordBatch], shards: int, postings: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, block, spilled = TaskContext.get().partitionId(), Block(), 0
    for batch in batches:
        columns = [batch.column(c).cast(t) for c, t in (("lang", pa.string()), ("source", pa.string()), ("text", pa.binary()))]
        for lang, source, text in zip(*columns):
            block.add(lang.as_py() or "", source.as_py() or "", text.as_py() or b"")
            if block.size >= postings:
                yield from block.run(f"{task}-{spilled}", shards)
                block, spilled = Block(), spilled + 1
    if block.docs:
        yield from block.run(f"{task}-{spilled}", shards)


def runs(docs: DataFrame, shards: int, postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The runs of ``docs`` (lang, source, text), a row per run, shard and language."""
    return docs.select("lang", "source", "text").mapInArrow(partial(_index, shards=shards, postings=postings), RUN)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Slice]]:
    """(into, shard, lang) and the slice of each row."""
    for b in batches:
        for k in range(len(b)):
            row = {c: b.column(c)[k] for c in b.schema.names}
            numbers = [row[c].values.to_numpy(zero_copy_only=False) for c in ("docs", "heads", "whom", "counts")]
            key = tuple(row[c].as_py() for c in ("into", "shard", "lang"))
            yield key, Slice(row["names"].as_py(), row["terms"].as_py(), *numbers)


def _merged(slices: list[Slice], min_docs: int = 1) -> Slice:
    """The slices merged by a heap, equal terms added up; terms in fewer than ``min_docs`` texts go."""
    names = sorted({s for x in slices for s in x.names})
    entries = list(heapq.merge(*[zip(x.terms, repeat(n), range(len(x.terms))) for n, x in enumerate(slices)]))
    if not entries:
        zero = np.zeros(0, np.int64)
        return Slice(names, [], zero, np.zeros(1, np.int64), zero, zero)
    terms, run, at = zip(*entries)
    first = np.array([True, *map(ne, terms, terms[1:])])
    starts = np.flatnonzero(first)
    offset = np.append(0, np.cumsum([len(x.terms) for x in slices]))[:-1]
    entry = offset[np.array(run)] + np.array(at)
    docs = np.add.reduceat(np.concatenate([x.docs for x in slices])[entry], starts)
    keep = docs >= min_docs
    # The postings of the entries of kept terms, in order of terms.
    index = {s: k for k, s in enumerate(names)}
    whom = np.concatenate([np.array([index[s] for s in x.names], np.int64)[x.whom] for x in slices])
    counts = np.concatenate([x.counts for x in slices])
    sizes = np.concatenate([np.diff(x.heads) for x in slices])
    begin = np.append(0, np.cumsum(sizes))[:-1]
    term = np.cumsum(first) - 1
    there = keep[term]
    entry, term = entry[there], (np.cumsum(keep) - 1)[term[there]]
    sizes, begin = sizes[entry], begin[entry]
    which = np.repeat(begin - np.append(0, np.cumsum(sizes))[:-1], sizes) + np.arange(int(sizes.sum()))
    key = np.repeat(term, sizes) * len(names) + whom[which]
    key, back = np.unique(key, return_inverse=True)
    added = np.zeros(len(key), np.int64)
    np.add.at(added, back, counts[which])
    n = int(keep.sum())
    heads = np.searchsorted(key, np.arange(n + 1) * len(names))
    return Slice(names, [terms[k] for k in starts[keep].tolist()], docs[keep], heads, key % max(len(names), 1), added)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[Slice]]]:
    for key, group in groupby(_slices(batches), itemgetter(0)):
        yield key, [s for _, s in group]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One longer run of the runs that share (into, shard, lang)."""
    for (into, shard, lang), slices in _groups(batches):
        yield _run_batch(into, shard, lang, _merged(slices))


def _finish(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Kept terms with the sources where they occur; a row without a term names all sources of a language."""
    for (_, shard, lang), slices in _groups(batches):
        s = _merged(slices, min_docs)
        sources = pa.array(s.names, pa.string())
        for lo in range(0, len(s.terms), 5000):
            hi = min(lo + 5000, len(s.terms))
            a, z = int(s.heads[lo]), int(s.heads[hi])
            upto = pa.array((s.heads[lo : hi + 1] - a).astype(np.int32))
            yield _kept_batch(lang, shard, pa.array(s.terms[lo:hi], pa.binary()).view(pa.string()),
                              pa.ListArray.from_arrays(upto, sources.take(pa.array(s.whom[a:z]))),
                              pa.ListArray.from_arrays(upto, pa.array(s.counts[a:z])))
        if shard == 0:
            yield _kept_batch(lang, shard, pa.array([None], pa.string()), pa.array([s.names], pa.list_(pa.string())),
                              pa.array([[0] * len(s.names)], pa.list_(pa.int64())))


def _kept_batch(lang: str, shard: int, terms: pa.Array, sources: pa.Array, counts: pa.Array) -> pa.RecordBatch:
    n = len(terms)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array([shard] * n, pa.int32()), terms, sources, counts],
        names=[c.split()[0] for c in KEPT.split(", ")],
    )


def frequencies(written: DataFrame, fan_in: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """``KEPT`` rows of a written table of runs, which is removed if merges before the last one were needed."""
    by = ("into", "shard", "lang")
    while True:
        count = written.select("run").distinct().count()
        groups_ = -(-count // fan_in)
        into = F.lit("all") if groups_ <= 1 else F.pmod(F.xxhash64("run"), F.lit(groups_)).cast("string")
        dealt = written.withColumn("into", into).repartition(shuffle_width(written), *by).sortWithinPartitions(*by)
        if groups_ <= 1:
            return dealt.mapInArrow(partial(_finish, min_docs=min_docs), KEPT)
        after = saved(dealt.mapInArrow(_merge, RUN), "runs")
        discard(written)
        written = after


def groups(found: DataFrame) -> DataFrame:
    """(lang, source, n, v): every occurring group with its occurrences of kept terms and the size of the vocabulary.

    The row that names all sources counts 0 for each, so it adds groups and no occurrences.
    """
    sums = (
        found.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("p"))
        .groupBy("lang", F.col("p.sources").alias("source")).agg(F.sum("p.counts").alias("n"))
    )
    sizes = found.groupBy(F.col("lang").alias("l")).agg(F.count("term").alias("v"))
    return sums.join(sizes, F.col("lang") == F.col("l")).select("lang", "source", "n", "v")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (n + 5 v)), exact: in 38 digits. Null without a vocabulary."""
    above = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif((n + SMOOTH * v).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.when(v > 0, F.call_function("div", above, below) + 1)


def _shares(counts: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """The same of numbers; counts too large for 64 bits after scaling go by Python's whole numbers."""
    if len(counts) and int(counts.max()) > (1 << 62) // SCALE:
        return np.array([1 + SCALE * (int(c) + SMOOTH) // (int(m) + SMOOTH * v) for c, m in zip(counts, n)], np.int64)
    return 1 + SCALE * (counts + SMOOTH) // (n + SMOOTH * v)


class Side:
    """The sources of a block, their sizes and the share of a term that they lack."""

    def __init__(self, sources: list[dict], v: int) -> None:
        self.names = [s["source"] for s in sources]
        self.at = {s: k for k, s in enumerate(self.names)}
        self.n, self.v = np.array([s["n"] for s in sources], np.int64), v
        self.zero = _shares(np.zeros(len(sources), np.int64), self.n, v)

    def of(self, r: dict) -> tuple[np.ndarray, np.ndarray]:
        here = [(self.at[s], c) for s, c in zip(r["sources"], r["counts"]) if s in self.at]
        whom = np.array([k for k, _ in here], np.int64)
        return whom, _shares(np.array([c for _, c in here], np.int64), self.n[whom], self.v)


def _correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources what the terms of this task add to the constant; the sources come before the terms."""
    rows = (r for b in batches for r in b.to_pylist())
    for (lang, _, _), group in groupby(rows, itemgetter("lang", "i", "j")):
        first = next(group)
        if first["left"] is None:
            continue  # a block without sources
        left, right = Side(first["left"], first["v"]), Side(first["right"], first["v"])
        base = np.abs(left.zero[:, None] - right.zero[None, :])
        total = np.zeros_like(base)
        for r in group:
            if r["left"] is not None:
                continue  # the same sources for another shard
            a, pa_ = left.of(r)
            b, pb = right.of(r)
            mine = right.zero.copy()
            mine[b] = pb
            total[a] += np.abs(pa_[:, None] - mine[None, :]) - base[a]
            rest = np.ones(len(left.names), bool)
            rest[a] = False
            at = np.ix_(rest, b)
            total[at] += np.abs(left.zero[rest][:, None] - pb[None, :]) - base[at]
        x, y = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(x), pa.string()), pa.array([left.names[k] for k in x.tolist()], pa.string()),
             pa.array([right.names[k] for k in y.tolist()], pa.string()), pa.array(total[x, y])],
            names=["lang", "a", "b", "more"],
        )


def pair_values(kept: DataFrame, grouped: DataFrame, source_block: int = SOURCE_BLOCK) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of different sources of a language."""
    blocks = grouped.groupBy(F.col("lang").alias("l")).agg(F.ceil(F.count(F.lit(1)) / source_block).cast("int").alias("k"))
    block = lambda name: F.pmod(F.xxhash64(name), F.col("k")).cast("int")
    side = (
        grouped.where("v > 0").join(blocks, F.col("lang") == F.col("l"))
        .groupBy("lang", "v", "k", block("source").alias("i"))
        .agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("left"))
    )
    other = side.select(F.col("lang").alias("lang2"), F.col("i").alias("j"), F.col("left").alias("right"))
    shards = kept.select(F.col("lang").alias("lang3"), "shard").distinct()
    heads = (
        side.join(other, (F.col("lang") == F.col("lang2")) & (F.col("i") <= F.col("j")))
        .join(shards, F.col("lang") == F.col("lang3"))
        .select("lang", "shard", "i", "j", F.lit("").alias("term"), F.lit(0).alias("place"), "v", "left", "right",
                F.lit(None).cast("array<string>").alias("sources"), F.lit(None).cast("array<bigint>").alias("counts"))
    )
    none = F.lit(None).cast("array<struct<source:string,n:bigint>>")
    each = (
        kept.join(small_or_shuffled(blocks, BROADCAST_GROUPS), F.col("lang") == F.col("l"))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.col("k") - 1)))
        .withColumn("here", F.filter(
            F.arrays_zip("sources", "counts"), lambda p: F.pmod(F.xxhash64(p["sources"]), F.col("k")).isin(F.col("i"), F.col("j"))
        ))
        .where(F.size("here") > 0)
        .select("lang", "shard", "i", "j", "term", F.lit(1).alias("place"), F.lit(0).cast("long").alias("v"),
                none.alias("left"), none.alias("right"), F.col("here.sources").alias("sources"), F.col("here.counts").alias("counts"))
    )
    more = (
        heads.union(each).repartition(shuffle_width(kept), "lang", "shard", "i", "j")
        .sortWithinPartitions("lang", "i", "j", "place")
        .mapInArrow(_correct, "lang string, a string, b string, more long")
        .groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    )
    # A pair of blocks is walked one way round; within a block both orders of a pair are there.
    swapped = more.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "more")
    both = more.unionByName(swapped).groupBy("lang", "a", "b").agg(F.max("more").alias("more"))
    both = both.select(F.col("lang").alias("ml"), "a", "b", "more")
    them = grouped.select(F.col("lang").alias("tl"), F.col("source").alias("item"), F.col("n").alias("tn"))
    pairs = grouped.join(them, (F.col("lang") == F.col("tl")) & (F.col("source") != F.col("item")))
    apart = F.abs(share(F.lit(0), F.col("n"), F.col("v")) - share(F.lit(0), F.col("tn"), F.col("v")))
    return pairs.join(
        both, (F.col("lang") == F.col("ml")) & (F.col("source") == F.col("a")) & (F.col("item") == F.col("b")), "left"
    ).select(
        "lang", "source", "item", (F.coalesce(apart * F.col("v"), F.lit(0)) + F.coalesce("more", F.lit(0))).alias("value")
    )


def term_values(kept: DataFrame, grouped: DataFrame) -> DataFrame:
    """(lang, source, item, value): kept terms of a group whose share is above the language's."""
    side = small_or_shuffled(
        grouped.select(F.col("lang").alias("l"), F.col("source").alias("s"), "n", "v"), BROADCAST_GROUPS
    )
    whole = grouped.groupBy(F.col("lang").alias("wl")).agg(F.sum("n").alias("all_n"))
    count = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
    rows = (
        kept.select("lang", "term", count.alias("all_count"), F.explode(F.arrays_zip("sources", "counts")).alias("p"))
        .join(small_or_shuffled(whole, BROADCAST_GROUPS), F.col("lang") == F.col("wl"))
        .join(side, (F.col("lang") == F.col("l")) & (F.col("p.sources") == F.col("s")))
    )
    p = share(F.col("p.counts"), F.col("n"), F.col("v"))
    q = share(F.col("all_count"), F.col("all_n"), F.col("v"))
    return rows.select("lang", F.col("s").alias("source"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, postings: int = BLOCK_POSTINGS, fan_in: int | None = None,
    source_block: int = SOURCE_BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source is from each other, and what it says most.

    Part ``pair`` ranks all other sources of the language by the sum of absolute differences of shares over the kept
    terms; part ``term`` ranks the ``top`` terms whose share in the source is above the language's. Ranks fall by value,
    ties by the item's UTF-8 bytes.

    Null language, source and text count as empty ones. A source without terms has shares too; without kept terms all
    values of pairs are 0. A language with one source has no pair; an empty table gives no rows. Rows that repeat count
    each. Other columns are ignored.
    """
    shards = shuffle_width(docs)
    written = saved(runs(docs, shards, postings), "runs")
    found = saved(frequencies(written, fan_in or max(16, 4 * shards), min_docs), "frequencies")
    discard(written)
    grouped = saved(groups(found), "groups")
    kept = found.where("term IS NOT NULL")
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(kept, grouped, source_block).withColumn("rank", F.row_number().over(by))
    terms = term_values(kept, grouped).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(terms, "term"))
