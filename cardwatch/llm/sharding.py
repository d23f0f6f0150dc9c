"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each partition go to each shard is drawn before any row moves: the matrix has the partitions' sizes as
row sums, the shards' sizes as column sums, and is multivariate hypergeometric in between. It is drawn as a tree, each
node splitting its shard counts between its two halves of the partitions. Then every partition permutes its rows and deals
them out by its line of the matrix, rows are exchanged, and every shard permutes what it got. The result is a uniform
permutation cut into shards whose sizes differ by at most one.

Draws, permutations and sums are DataFrame functions; pseudo-random numbers are hashes of a seed and a fixed place, so that a
task that runs again does the same. What is gathered in one row are counts per partition and shard, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwatch.llm.common import let, saved, small_or_shuffled, unit_interval

SHARDS = 24
SEED = 20240229
#: Rows that one task permutes inside a shard, about; a large shard is permuted by ranges of its random keys.
BUCKET_ROWS = 200_000
BROADCAST_ROWS = 100_000


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Of ``drawn`` out of ``total``, how many are among the ``good``, by inversion of ``u`` in [0, 1).

    Probabilities are walked from the mode outwards by their ratios, relative to the mode's, so no factorials are
    needed. The walk spans ten standard deviations and 30 more; what lies outside is below the resolution of ``u``.
    """
    lowest = F.greatest(F.lit(0).cast("long"), drawn + good - total)
    highest = F.least(drawn, good)
    share = good.cast("double") / F.greatest(total, F.lit(1))
    spread = F.sqrt(
        drawn * share * (1 - share) * (total - drawn).cast("double") / F.greatest(total - 1, F.lit(1))
    )
    mode = F.floor((drawn + 1).cast("double") * (good + 1) / (total + 2)).cast("long")
    mode = F.least(F.greatest(mode, lowest), highest)
    reach = (10 * spread + 30).cast("long")

    def walk(p: Column) -> Column:
        k0, lo, hi = p["mode"], F.greatest(p["lowest"], p["mode"] - p["reach"]), F.least(p["highest"], p["mode"] + p["reach"])

        def up(k: Column) -> Column:  # p(k + 1) / p(k)
            return ((good - k) * (drawn - k)).cast("double") / ((k + 1) * (total - good - drawn + k + 1))

        def down(k: Column) -> Column:  # p(k - 1) / p(k)
            return (k * (total - good - drawn + k)).cast("double") / ((good - k + 1) * (drawn - k + 1))

        steps = lambda n: F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(
            F.array().cast("array<bigint>")
        )
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        above = F.aggregate(
            steps(hi - k0), start,
            lambda a, i: let(a["w"] * up(k0 + i - 1), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))),
        )["sum"]
        below = F.aggregate(
            steps(k0 - lo), start,
            lambda a, i: let(a["w"] * down(k0 - i + 1), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))),
        )["sum"]

        def search(target: Column) -> Column:
            """Take weights off the target: the mode's, then those above, then those below."""
            none = F.lit(None).cast("long")
            first = F.struct(
                F.lit(1.0).alias("w"), (target - 1.0).alias("left"), F.when(target < 1.0, k0).otherwise(none).alias("k")
            )

            def go(ratio, sign: int):
                def step(a: Column, i: Column) -> Column:
                    at = k0 + sign * (i - 1)
                    return F.when(a["k"].isNotNull(), a).otherwise(
                        let(
                            a["w"] * ratio(at),
                            lambda w: F.struct(
                                w.alias("w"), (a["left"] - w).alias("left"),
                                F.when(a["left"] < w, at + sign).otherwise(none).alias("k"),
                            ),
                        )
                    )

                return step

            def lower(a: Column) -> Column:
                again = F.struct(F.lit(1.0).alias("w"), a["left"].alias("left"), a["k"].alias("k"))
                # Rounding may leave a trace of the target behind the last weight; it goes to the lowest.
                return F.coalesce(F.aggregate(steps(k0 - lo), again, go(down, -1))["k"], lo)

            return let(F.aggregate(steps(hi - k0), first, go(up, 1)), lower)

        return let((1.0 + above + below) * u, search)

    return let(
        F.struct(mode.alias("mode"), lowest.alias("lowest"), highest.alias("highest"), reach.alias("reach")), walk
    )


def multivariate(counts: Column, drawn: Column, *key: Column) -> Column:
    """How many of ``drawn`` come from each of the ``counts``; the draws are fixed by ``key``."""
    start = F.struct(
        F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        drawn.cast("long").alias("left"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def step(a: Column, m: Column) -> Column:
        taken = hypergeometric(a["total"], m, a["left"], unit_interval(*key, F.size(a["out"])))
        return let(
            taken,
            lambda x: F.struct(
                (a["total"] - m).alias("total"), (a["left"] - x).alias("left"), F.concat(a["out"], F.array(x)).alias("out")
            ),
        )

    return F.aggregate(counts, start, step)["out"]


def matrix(sizes: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(part, counts): for every partition of ``sizes`` (part, n) how many rows each shard gets.

    The tree of splits starts from one row that holds the sizes of all partitions, a number each. Its rows are dealt out
    anew now and then, so that the nodes of a level are split side by side.
    """
    root = sizes.agg(
        F.sort_array(F.collect_list(F.struct("part", F.col("n").cast("long").alias("n")))).alias("parts"),
        F.sum("n").cast("long").alias("rows"), F.count(F.lit(1)).alias("width"),
    )
    width = root.select("width").first()[0]
    share = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda j: F.floor(F.col("rows") / shards).cast("long")
        + F.when(j < F.col("rows") % shards, 1).otherwise(0).cast("long"),
    )
    level = root.where("width > 0").select("parts", share.alias("counts"), F.lit(1).cast("long").alias("node"))
    depth = max(width - 1, 0).bit_length()
    for at in range(depth):
        if at % 4 == 3:
            level = saved(level.repartition(min(1 << at, 64), "node"), "splits")
        half = F.ceil(F.size("parts") / 2).cast("int")
        left = F.slice("parts", F.lit(1), half)
        right = F.slice("parts", half + 1, F.size("parts"))
        rows = F.aggregate(left, F.lit(0).cast("long"), lambda a, p: a + p["n"])
        mine = multivariate(F.col("counts"), rows, F.lit(seed), F.col("node"))
        both = let(
            mine,
            lambda m: F.array(
                F.struct(left.alias("parts"), m.alias("counts"), (2 * F.col("node")).alias("node")),
                F.struct(
                    right.alias("parts"),
                    F.zip_with(F.col("counts"), m, lambda c, x: c - x).alias("counts"),
                    (2 * F.col("node") + 1).alias("node"),
                ),
            ),
        )
        split = level.select(F.explode(both).alias("s"))
        level = split.where(F.size("s.parts") > 0).select("s.parts", "s.counts", "s.node")
    return level.select(F.col("parts")[0]["part"].alias("part"), "counts")


def shuffle(rows: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: a uniform permutation in shards whose sizes differ by at most one.

    Slots run from 0 without gaps in every shard. Rows are told apart by their place in the written input, so
    repeated rows, null keys and ties take part like any other. A table without rows gives none. The columns of
    ``rows`` are carried along; pass only those that are needed. ``shard`` and ``slot`` replace columns of these names.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    placed = saved(
        rows.select(
            F.struct(*kept).alias("row"), F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "places",
    )
    lines = saved(matrix(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")), shards, seed), "matrix")
    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "place"), "place")
    upto = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda j: F.aggregate(F.slice("counts", F.lit(1), j), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    dealt = (
        placed.withColumn("nth", F.row_number().over(local))
        .join(small_or_shuffled(lines.select("part", upto.alias("upto")), BROADCAST_ROWS), "part")
        .select(
            "row", "place",
            # Shards that this partition is done with lie before the one that takes its nth row.
            F.size(F.filter("upto", lambda x: x < F.col("nth"))).alias("shard"),
        )
    )
    total = placed.count()
    buckets = max(1, -(-total // (shards * bucket_rows)))
    key = F.xxhash64(F.lit(seed), F.lit("order"), "place")
    exchanged = dealt.select(
        "row", "shard", key.alias("key"), "place",
        F.floor(unit_interval(F.lit(seed), F.lit("order"), F.col("place")) * buckets).cast("long").alias("bucket"),
    )
    sizes = exchanged.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "place")
    return (
        exchanged.withColumn("nth", F.row_number().over(inside) - 1)
        .join(small_or_shuffled(saved(offsets, "offsets"), BROADCAST_ROWS),
              (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
        .select("row.*", "shard", (F.col("first") + F.col("nth")).cast("long").alias("slot"))
    )


def assignments(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes (none for null) plus 8. The law is ``rows``: counts of shards differ by one at most.
    The CRC of a null text is that of no bytes; ``grown_shard`` is null, as more shards mean a new shuffle.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return shuffle(narrow, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
