"""Near-duplicate documents by a prefix-tree join over word shingles (Jaccard similarity).

1. Every text becomes the set of its distinct word shingles (64-bit hashes); equal sets, told by 128 bits
   (``print``), are one class.
2. Tokens are dealt to buckets by hash, many texts to a row. A bucket counts in how many classes each of
   its tokens occurs and sends back those with two or more. That is the global order: rare first, ties
   by token.
3. A class of ``n`` shingles can link only if two classes meet in the first ``n - ceil(t n) + 1`` of this
   order. If so many of its tokens occur nowhere else, it is done; only the rest go on.
4. Classes that share a token of these prefixes are joined to candidate groups (connected components). Any
   link lies within a group, so each set is shipped once.
5. In a group the sets, most frequent tokens first, form a trie; each set walks it (see ``trie``). A group
   beyond ``group_tokens`` is cut into blocks and every pair of blocks is walked on its own, so that no
   task holds more than two blocks.
6. Links give components, and each component its least doc_id.

No pair of a group is ever written: a walk yields one edge per set that was linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cardwatch.llm import trie, wordhash
from cardwatch.llm.common import discard, saved, shuffle_width, small_or_shuffled
from cardwatch.llm.components import components

WIDTH = 5
PERCENT = 80
#: Tokens of a group, or of a block of it, that one task holds at a time.
GROUP_TOKENS = 4_000_000
#: Tokens of a bucket, about; a task works off its buckets one by one.
BUCKET_TOKENS = 4_000_000
#: Ids of rows to drop that are broadcast at most; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: A print, as two numbers.
PRINT = np.dtype([("a", "<u8"), ("b", "<u8")])


def _texts(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        data, offsets = wordhash.text_bytes(batch.column("text"))
        for lo, hi in wordhash.pieces(offsets):
            yield batch, lo, hi, wordhash.words(data, offsets[lo : hi + 1])


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch, lo, hi, w in _texts(batches):
        sizes, prints = [], []
        for s in wordhash.shingle_sets(w, width):
            sizes.append(len(s))
            prints.append(wordhash.set_print(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").slice(lo, hi - lo), pa.array(sizes, pa.int64()),
             pa.array(prints, pa.binary())],
            names=["doc_id", "n_shingles", "print"],
        )


def shingle_table(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, print) per row; equal sets have equal prints, the empty set an empty one."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_describe, width=width), "doc_id long, n_shingles long, print binary"
    )


def _deal(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for _, _, _, w in _texts(batches):
        sets, seen = [], set()
        for s in wordhash.shingle_sets(w, width):
            key = wordhash.set_print(s)
            if key and key not in seen:
                seen.add(key)
                sets.append((key, s))
        if not sets:
            continue
        lengths = np.array([len(s) for _, s in sets])
        tokens = np.concatenate([s for _, s in sets])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), lengths)
        bucket = ((tokens >> np.uint64(20)) % np.uint64(buckets)).astype(np.uint16 if buckets < 65536 else np.int64)
        order = np.argsort(bucket, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        prints = np.frombuffer(b"".join(k for k, _ in sets), PRINT)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        rows = []
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tokens)]):
            own = owner[a:z]
            heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            who = own[heads]
            counts = np.diff(np.append(heads, z - a)).astype(np.uint32)
            rows.append(
                (int(bucket[a]), prints[who].tobytes(), lengths[who].astype(np.uint32).tobytes(),
                 counts.tobytes(), tokens[a:z].tobytes())
            )
        yield _blob_rows(rows)


_BLOBS = "bucket long, prints binary, sizes binary, counts binary, tokens binary"


def _blob_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["bucket", "prints", "sizes", "counts", "tokens", "orders"][: len(rows[0])]
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
        names=names,
    )


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of sorted batches by key; one key's rows at a time."""
    # A batch may hold many groups of large blobs, so few of its rows become Python objects at a time.
    rows = (r for b in batches for i in range(0, b.num_rows, 64) for r in b.slice(i, 64).to_pylist())
    for key, group in groupby(rows, lambda r: tuple(r[k] for k in keys)):
        yield key, list(group)
    pa.default_memory_pool().release_unused()  # workers outlive a task


def _joined(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name] for r in rows), kind)


def _repeated(tokens: np.ndarray) -> np.ndarray:
    """Places of the tokens that come twice or more, by token; a share of the tokens is sorted at a time."""
    found, share = [], (tokens >> np.uint64(61)).astype(np.uint8)
    for i in range(8):
        order = np.flatnonzero(share == i)
        order = order[np.argsort(tokens[order])]
        t = tokens[order]
        same = t[1:] == t[:-1]
        found.append(order[np.append(same, False) | np.append(False, same)] if len(t) else order)
    return np.concatenate(found)


def _count_bucket(batches: Iterator[pa.RecordBatch], homes: int) -> Iterator[pa.RecordBatch]:
    """Tokens of a bucket that two or more classes have, sent to the classes' homes."""
    for _, rows in _runs(batches, "bucket"):
        counts = _joined(rows, "counts", np.uint32)
        prints, sizes = _joined(rows, "prints", PRINT), _joined(rows, "sizes", np.uint32)
        tokens = _joined(rows, "tokens", np.uint64)
        del rows
        # Most tokens occur once; a print beside each of them would be thrice their size.
        owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        order = _repeated(tokens)
        if not len(order):
            continue
        t, own = tokens[order], owner[order]
        del tokens, owner, order
        p, n = prints[own], sizes[own]
        order = np.lexsort((p["b"], p["a"], t))
        t, p, n = t[order], p[order], n[order]
        new = np.append(True, (t[1:] != t[:-1]) | (p[1:] != p[:-1]))
        t, p, n = t[new], p[new], n[new]  # copies in different pieces count once
        heads = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        classes = np.diff(np.append(heads, len(t)))
        f = np.minimum(np.repeat(classes, classes), 65535).astype(np.uint16)
        many = f > 1
        t, p, n, f = t[many], p[many], n[many], f[many]
        home = (p["a"] >> np.uint64(24)) % np.uint64(homes)
        order = np.lexsort((t, f, p["b"], p["a"], home))
        t, p, n, f, home = (x[order] for x in (t, p, n, f, home))
        out = []
        cuts = np.flatnonzero(np.diff(home)) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(t)]):
            if a == z:
                continue
            heads = np.flatnonzero(np.append(True, p[a + 1 : z] != p[a : z - 1]))
            out.append(
                (int(home[a]), p[a:z][heads].tobytes(), n[a:z][heads].tobytes(),
                 np.diff(np.append(heads, z - a)).astype(np.uint32).tobytes(),
                 t[a:z].tobytes(), f[a:z].tobytes())
            )
        if out:
            yield _blob_rows(out)


_CANDIDATE = "print binary, size long, n_kept long, tokens binary, prefix array<bigint>"


def _candidates(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Classes that have too few tokens of their own to be alone, with their prefix."""
    for _, rows in _runs(batches, "bucket"):
        counts = _joined(rows, "counts", np.uint32)
        p = np.repeat(_joined(rows, "prints", PRINT), counts)
        n = np.repeat(_joined(rows, "sizes", np.uint32), counts).astype(np.int64)
        t, f = _joined(rows, "tokens", np.uint64), _joined(rows, "orders", np.uint16)
        del rows
        order = np.lexsort((t, f, p["b"], p["a"]))
        p, n, t = p[order], n[order], t[order]
        heads = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        kept = np.diff(np.append(heads, len(p)))
        size = n[heads]
        take = size - (percent * size + 99) // 100 + 1 - (size - kept)
        out = [
            (p[h].tobytes(), int(s), int(k), t[h : h + k].tobytes(), t[h : h + c].astype(np.int64))
            for h, s, k, c in zip(heads.tolist(), size.tolist(), kept.tolist(), take.tolist())
            if c > 0
        ]
        for lo in range(0, len(out), 2000):
            columns = list(zip(*out[lo : lo + 2000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), *[pa.array(c, pa.int64()) for c in columns[1:3]],
                 pa.array(columns[3], pa.binary()),
                 pa.array(columns[4], pa.list_(pa.int64()))],
                names=["print", "size", "n_kept", "tokens", "prefix"],
            )


def _walk(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for _, rows in _runs(batches, "root", "i", "j"):
        if len(rows) > 1:
            keys = np.arange(len(rows))
            by = sorted(rows, key=lambda r: r["print"])
            to = trie.linked(
                keys, [np.frombuffer(r["tokens"], np.uint64) for r in by],
                np.array([r["size"] for r in by]), percent,
            )
            linked = [(by[k], by[m]) for k, m in zip(keys.tolist(), to.tolist()) if k != m]
            if linked:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["print"] for x, _ in linked], pa.binary()),
                     pa.array([y["print"] for _, y in linked], pa.binary())],
                    names=["a", "b"],
                )


def candidate_sets(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, buckets: int | None = None
) -> DataFrame:
    """Classes that may have a partner, in the global order: (print, size, n_kept, tokens, prefix)."""
    tasks = shuffle_width(docs)
    buckets = buckets or tasks
    dealt = docs.select("text").mapInArrow(partial(_deal, width=width, buckets=buckets), _BLOBS)
    repeated = (
        dealt.repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(partial(_count_bucket, homes=buckets), _BLOBS + ", orders binary")
    )
    return (
        repeated.repartition(tasks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(partial(_candidates, percent=percent), _CANDIDATE)
    )


def link_components(sets: DataFrame, percent: int = PERCENT, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(node, root) of the linked classes of a written table of candidate sets, by their prints."""
    members = sets.select(F.col("print").alias("node"), F.explode("prefix").alias("token"))
    least = members.groupBy("token").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
    edges = (
        members.join(least.where("n > 1"), "token").where("node <> least").select("node", "least").distinct()
    )
    groups = components(edges, "node", "least")
    placed = saved(
        sets.select("print", "size", "n_kept", "tokens").join(groups, F.col("print") == F.col("node")), "groups"
    )
    sums = placed.groupBy("root").agg(F.sum("n_kept").alias("total"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("total") / group_tokens)).cast("int")
    dealt = (
        placed.join(sums.select("root", blocks.alias("k")), "root")
        .withColumn("block", F.pmod(F.xxhash64("print"), F.col("k")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select("print", "size", "tokens", "root", F.least("block", "other").alias("i"),
                F.greatest("block", "other").alias("j"))
    )
    links = (
        dealt.repartition(shuffle_width(sets), "root", "i", "j")
        .sortWithinPartitions("root", "i", "j")
        .mapInArrow(partial(_walk, percent=percent), "a binary, b binary")
    )
    found = components(links)
    discard(placed)
    return found


def _resolved(docs: DataFrame, width: int, percent: int, group_tokens: int) -> DataFrame:
    """(doc_id, n_shingles, print, root, component_id) per row; a row without shingles has no root."""
    described = saved(shingle_table(docs, width), "shingles")
    tokens = described.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    buckets = max(shuffle_width(docs), -(-tokens // BUCKET_TOKENS))
    sets = saved(candidate_sets(docs, width, percent, buckets), "sets")
    roots = link_components(sets, percent, group_tokens)
    discard(sets)
    classes = (
        described.where("n_shingles > 0")
        .groupBy("print")
        .agg(F.min("doc_id").alias("least"))
        .join(roots, F.col("print") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "print"))
    )
    # A component's least id comes by an aggregate and an equality join: a component may be any size.
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select(
        F.col("print").alias("p"), "root", "component_id"
    )
    return described.join(named, F.col("print") == F.col("p"), "left").select(
        "doc_id",
        "n_shingles",
        "print",
        "root",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links).

    Words are lower-cased in A-Z. A null or empty text, or one without words, has no shingle and is linked
    with nothing: its component_id is its doc_id. Equal sets are linked. Rows that repeat a doc_id are
    rows of their own; a null doc_id joins no minimum, so a component of such rows alone has a null id. An
    empty table gives no rows. Columns other than doc_id and text are ignored.
    """
    return _resolved(docs, width, percent, group_tokens).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id; all columns stay.

    Texts without words are no duplicates and all stay. A null doc_id comes after all others. Of several rows
    of a component that have its least doc_id, or of one that has null ids alone, the row with the least set
    stays, and of equal sets the least row by text and the other columns, in whatever order the rows came.
    """
    found = saved(_resolved(docs.select("doc_id", "text"), width, percent, GROUP_TOKENS), "components")
    gone = small_or_shuffled(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")), BROADCAST_IDS
    )
    # An id stays with some rows and goes with others only if it repeats; such rows are told by their set.
    repeated = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    odd = saved(repeated.select(F.col("doc_id").alias("__odd")), "repeated")
    if odd.isEmpty():
        return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    odd = small_or_shuffled(odd, BROADCAST_IDS)
    single = docs.where("doc_id IS NOT NULL").join(odd, F.col("doc_id") == F.col("__odd"), "left_anti").join(
        gone, F.col("doc_id") == F.col("__gone"), "left_anti"
    )
    return single.unionByName(_of_repeated_ids(docs, odd, found, width))


def _with_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The rows as they are, with the print of their sets behind."""
    for batch, lo, hi, w in _texts(batches):
        prints = [wordhash.set_print(s) for s in wordhash.shingle_sets(w, width)]
        yield pa.RecordBatch.from_arrays(
            [*batch.slice(lo, hi - lo).columns, pa.array(prints, pa.binary())],
            names=[*batch.schema.names, "__print"],
        )


def _of_repeated_ids(docs: DataFrame, odd: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Rows whose doc_id repeats or is null: those without words, and one for each component that such a row stands for."""
    columns = docs.columns
    rows = docs.join(odd, F.col("doc_id").eqNullSafe(F.col("__odd")), "left_semi")
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print")).alias("first")
    stays = (
        found.where("n_shingles > 0").groupBy("root").agg(first)
        .select(F.col("root").alias("__root"), F.col("first.doc_id").alias("__id"), F.col("first.print").alias("__p"))
        .join(odd, F.col("__id").eqNullSafe(F.col("__odd")), "left_semi")
    )
    sized = StructType([*docs.schema.fields, StructField("__print", BinaryType())])
    kept = (
        rows.where(worded).mapInArrow(partial(_with_sets, width=width), sized)
        .join(
            small_or_shuffled(stays, BROADCAST_IDS),
            F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__p")),
        )
        .groupBy("__root").agg(F.min(F.struct("text", *[c for c in columns if c != "text"])).alias("one"))
    )
    return kept.select("one.*").select(*columns).unionByName(rows.where(~worded))
