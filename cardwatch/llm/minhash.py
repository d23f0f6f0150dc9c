"""Near-duplicate documents by min-max hashing over word shingles (Jaccard similarity).

1. Every text becomes the set of its distinct word shingles; equal sets (128-bit prints) are one class from here on.
2. A permutation of the 64-bit shingle hashes is an affine map. Both the least and the greatest value of a set under
   it are kept, so 64 evaluations a shingle give 128 signature values, each equal for two sets with the probability of
   their similarity.
3. Four values make a band: 16 bands of minima, 16 of maxima. Two sets of similarity 0.8 share no band with a
   probability of (1 - 0.8^4)^32 = 5e-8. Buckets of the same members count once.
4. Every member of a bucket is compared with the bucket's least member, on the full sets. Links give components; that
   settles groups of copies of any size with one comparison a member.
5. Buckets that still hold members of several components, their least member aside, are compared crosswise: members
   outside the bucket's largest component against all of another component, in blocks of bounded size. Nothing within a
   component is compared again, and no pair is written unless it is a link between components.

So all pairs of a bucket are decided on their full sets: by a comparison, or as members of one component already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import wordhash
from cardwatch.llm.common import discard, saved, shuffle_width, small_or_shuffled
from cardwatch.llm.components import components

WIDTH = 4
PERCENT = 80
PERMUTATIONS = 64
#: Signature values of a band.
BAND = 4
#: Comparisons with one leader that a task makes at a time; a leader of more is dealt out in pieces.
PIECE = 1000
#: Shingles of a block of a bucket.
BLOCK_TOKENS = 1_000_000
#: Ids of candidate documents that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def _permutations(n: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands: each pair permutes the numbers of 64 bits."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 63, (2, n), np.uint64) * np.uint64(2)
    return a + np.uint64(1), b


def signatures(tokens: np.ndarray, heads: np.ndarray, permutations: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(minima, maxima), a column per permutation and a row per set; the sets lie in ``tokens`` from ``heads`` on."""
    low = np.empty((permutations, len(heads)), np.uint64)
    high = np.empty_like(low)
    for k, (a, b) in enumerate(zip(*_permutations(permutations))):
        value = tokens * a + b
        low[k] = np.minimum.reduceat(value, heads)
        high[k] = np.maximum.reduceat(value, heads)
    return low.T, high.T


def bands(low: np.ndarray, high: np.ndarray, band: int = BAND) -> np.ndarray:
    """A hash per set and band; the number of the band is part of the hash."""
    parts = []
    for values in (low, high):
        for at in range(0, values.shape[1], band):
            h = np.full(len(values), len(parts) + 1, np.uint64)
            for k in range(at, min(at + band, values.shape[1])):
                h = wordhash.mix(h + values[:, k])
            parts.append(h)
    return np.stack(parts, axis=1)


def _pieces(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        data, offsets = wordhash.text_bytes(batch.column("text"))
        for lo, hi in wordhash.pieces(offsets):
            yield batch.column("doc_id").slice(lo, hi - lo), list(
                wordhash.shingle_sets(wordhash.words(data, offsets[lo : hi + 1]), width)
            )


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for ids, sets in _pieces(batches, width):
        sizes = np.array([len(s) for s in sets], np.int64)
        there = np.flatnonzero(sizes)
        hashes = np.zeros((0, 2 * -(-PERMUTATIONS // BAND)), np.uint64)
        if len(there):
            heads = np.append(0, np.cumsum(sizes[there])[:-1])
            hashes = bands(*signatures(np.concatenate([sets[i] for i in there.tolist()]), heads))
        # Texts without shingles have no bands.
        upto = np.append(0, np.cumsum(np.where(sizes > 0, hashes.shape[1], 0))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes), pa.array([wordhash.set_print(s) for s in sets], pa.binary()),
             pa.ListArray.from_arrays(pa.array(upto), pa.array(hashes.reshape(-1).view(np.int64)))],
            names=["doc_id", "n_shingles", "print", "bands"],
        )


def signed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, print, bands) per row; the empty set has an empty print and no bands."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_sign, width=width), "doc_id long, n_shingles long, print binary, bands array<bigint>"
    )


def _same_members(*extra: Column) -> list[Column]:
    """128 bits that tell the members of a bucket, whatever their order."""
    return [F.bit_xor(F.xxhash64("print")).alias("x"), F.bit_xor(F.xxhash64("print", F.lit(1))).alias("y"), *extra]


def bucket_members(classes: DataFrame) -> DataFrame:
    """(band, print, n, leader, leader_n) for the members of buckets of two classes or more, equal buckets once."""
    members = classes.select("print", "n", F.explode("bands").alias("band"))
    buckets = (
        members.groupBy("band")
        .agg(*_same_members(F.count(F.lit(1)).alias("m"), F.min(F.struct("print", "n")).alias("first")))
        .where("m > 1")
        .groupBy("m", "x", "y", "first").agg(F.min("band").alias("band"))
        .select("band", F.col("first.print").alias("leader"), F.col("first.n").alias("leader_n"))
    )
    return members.join(buckets, "band")


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for _, sets in _pieces(batches, width):
        sets = [s for s in sets if len(s)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([wordhash.set_print(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["print", "tokens"],
        )


def full_sets(docs: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(print, tokens) of the ``wanted`` classes (print, least), each from a row with the class's least doc_id."""
    ids = small_or_shuffled(wanted.select(F.col("least").alias("__least")).distinct(), BROADCAST_IDS)
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(
        ids, F.col("doc_id").eqNullSafe(F.col("__least")), "left_semi"
    )
    sets = rows.mapInArrow(partial(_sets, width=width), "print binary, tokens binary")
    # Ids may repeat with other texts, and texts may repeat under an id.
    return sets.join(wanted.select("print"), "print", "left_semi").dropDuplicates(["print"])


def _rows(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        for r in b.to_pylist():
            r["tokens"] = np.frombuffer(r["tokens"], np.uint64)
            yield r


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _linked(common: np.ndarray | int, n: int, m: np.ndarray | int, percent: int):
    """100 * intersection >= percent * union."""
    return (100 + percent) * common >= percent * (n + m)


def _with_leader(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A leader's set comes first, then those of its members."""
    leader, own, found = None, np.zeros(0, np.uint64), []
    for r in _rows(batches):
        if r["place"] == 0:
            leader, own = r["leader"], r["tokens"]
            continue
        at = np.minimum(np.searchsorted(own, r["tokens"]), len(own) - 1)
        common = int(np.count_nonzero(own[at] == r["tokens"]))
        if _linked(common, len(own), len(r["tokens"]), percent):
            found.append((leader, r["print"]))
        if len(found) >= 5000:
            yield _links(found)
            found = []
    yield _links(found)


def leader_links(members: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): links of members with the leaders of their buckets."""
    near = F.least("n", "leader_n") * 100 >= F.greatest("n", "leader_n") * percent
    pairs = members.where((F.col("print") != F.col("leader")) & near).select("leader", "print").distinct()
    pieces = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("k"))
    dealt = pairs.join(pieces, "leader").select(
        "leader", F.pmod(F.xxhash64("print"), F.col("k")).cast("int").alias("piece"), F.lit(1).alias("place"), "print"
    )
    heads = pieces.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("piece"), F.lit(0).alias("place"),
        F.col("leader").alias("print"),
    )
    return (
        dealt.union(heads).join(sets, "print")
        .repartition(shuffle_width(members), "leader", "piece")
        .sortWithinPartitions("leader", "piece", "place")
        .mapInArrow(partial(_with_leader, percent=percent), "a binary, b binary")
    )


def _cross(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between members of different components: the cell (i, j) compares block i with block j, or with itself."""
    for (_, i, j), group in groupby(_rows(batches), lambda r: (r["band"], r["i"], r["j"])):
        rows = list(group)
        label = {}
        own = np.array([label.setdefault(r["label"], len(label)) for r in rows])
        names, block = list(label), np.array([r["block"] for r in rows])
        probes = np.flatnonzero(block == i)
        if len(names) < 2 or not len(probes):
            continue
        lengths = np.array([len(r["tokens"]) for r in rows])
        starts = np.append(0, np.cumsum(lengths)[:-1])
        values, ranks = np.unique(np.concatenate([r["tokens"] for r in rows]), return_inverse=True)
        mask, now, found = np.zeros(len(values), np.int32), own.copy(), []
        for x in probes.tolist():
            other = (now != now[x]) & (block == j)
            if not other.any():
                continue
            mine = ranks[starts[x] : starts[x] + lengths[x]]
            mask[mine] = 1
            common = np.add.reduceat(mask[ranks], starts)
            mask[mine] = 0
            for y in np.flatnonzero(other & _linked(common, int(lengths[x]), lengths, percent)).tolist():
                if now[y] != now[x]:
                    found.append((names[own[x]], names[own[y]]))
                    now[now == now[y]] = now[x]
        if found:
            yield _links(found)


def cross_links(labelled: DataFrame, sets: DataFrame, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(a, b): links between components, from members (band, print, n, leader, label) of the buckets.

    In a bucket the members of its largest component are dealt to blocks of their own; they are never compared with
    each other, and each block of the others meets each of theirs.
    """
    rest = labelled.where(F.col("print") != F.col("leader"))
    parts = rest.groupBy("band", "label").agg(
        *_same_members(F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens"))
    )
    top = F.max_by(F.struct("label", "tokens"), F.struct("m", "label")).alias("top")
    buckets = (
        parts.groupBy("band")
        .agg(F.count(F.lit(1)).alias("labels"), F.sum("m").alias("m"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
             F.sum("tokens").alias("tokens"), top)
        .where("labels > 1")
        .groupBy("m", "x", "y").agg(F.min_by(F.struct("band", "top", "tokens"), "band").alias("b"))
        .select(
            "b.band", F.col("b.top.label").alias("main"),
            F.ceil((F.col("b.tokens") - F.col("b.top.tokens")) / block_tokens).cast("int").alias("k"),
            F.ceil(F.col("b.top.tokens") / block_tokens).cast("int").alias("main_k"),
        )
    )
    placed = rest.join(buckets, "band").withColumn("of_main", F.col("label") == F.col("main"))
    block = F.pmod(F.xxhash64("print"), F.when(F.col("of_main"), F.col("main_k")).otherwise(F.col("k"))).cast("int")
    dealt = (
        placed.withColumn("block", block + F.when(F.col("of_main"), F.col("k")).otherwise(0))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.when(F.col("of_main"), F.col("k")).otherwise(F.col("k") + F.col("main_k")) - 1)))
        .select("band", "print", "label", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))
    )
    return (
        dealt.join(sets, "print")
        .repartition(shuffle_width(labelled), "band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .mapInArrow(partial(_cross, percent=percent), "a binary, b binary")
    )


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links), kept (it is that one).

    Words are lower-cased in A-Z. A null or empty text, or one without words, has no shingle, is linked with nothing
    and kept. Equal sets are linked. Rows that repeat a doc_id are rows of their own; a null doc_id joins no minimum,
    so a component of such rows alone has a null id, and its rows are kept. An empty table gives no rows. Columns other
    than doc_id (a whole number) and text are ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text")
    rows = saved(signed(docs, width), "signed")
    classes = saved(
        rows.where("n_shingles > 0").groupBy("print").agg(
            F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    members = saved(bucket_members(classes), "members")
    wanted = members.select("print").distinct().join(classes.select("print", "least"), "print")
    sets = saved(full_sets(docs, saved(wanted, "wanted"), width), "sets")
    first = saved(components(leader_links(members, sets, percent)), "components")
    labelled = members.join(first, F.col("print") == F.col("node"), "left").select(
        "band", "print", "n", "leader", F.coalesce("root", "print").alias("label")
    )
    labelled = saved(labelled, "labelled")
    second = components(cross_links(labelled, sets, percent, block_tokens))
    for done in (members, labelled, sets):
        discard(done)
    then = second.select(F.col("node").alias("was"), F.col("root").alias("then"))
    named = (
        classes.select("print", "least").join(first, F.col("print") == F.col("node"), "left")
        .withColumn("mid", F.coalesce("root", "print"))
        .join(then, F.col("mid") == F.col("was"), "left")
        .select(F.col("print").alias("p"), "least", F.coalesce("then", "mid").alias("end"))
    )
    least = named.groupBy("end").agg(F.min("least").alias("component_id"))
    found = rows.select("doc_id", "n_shingles", "print").join(
        named.join(least, "end").select("p", "component_id"), F.col("print") == F.col("p"), "left"
    )
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
