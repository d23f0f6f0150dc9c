"""Benchmark overlap by spaced seeds, tolerant of substituted words.

A mask takes six of eight word positions and ignores the rest. Both masks are hashed at every position of the
benchmark and of every document; equal hashes join. The two masks together hit every window of 13 words with up
to two substitutions wherever they fall (all 78 pairs are covered). Shorter items have masks without gaps: the two halves of
8 to 12 words, one of which is whole after one substitution, and all words of 4 to 7. Documents are hashed by those
lengths only that the benchmark asks for. A hit fixes an alignment of item and document, along which all words are then
compared.

Everything is DataFrame functions. The benchmark's hashes and the ids of hit documents are broadcast only after
they were counted; beyond the bound both joins shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import let, saved, small_or_shuffled

# The positions that the masks look at.
MASKS = ((0, 1, 2, 3, 6, 7), (0, 1, 3, 5, 6, 7))
SPAN = 8
#: A run of so many aligned words with so many equal ones is a leak.
WINDOW = 13
WINDOW_EQUAL = 11
#: Items shorter than a window may differ in one word from so many words on; shorter ones must be equal throughout.
ONE_CHANGE = 8
#: Items of fewer words are no passage: only a document that consists of them alone holds them.
PASSAGE = 4
BROADCAST_ROWS = 500_000

# Scripts that set no spaces between words; each of their characters is a word here.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"

#: All of them lie here; a look for one range is cheap, and most texts have nothing in it.
BEYOND = "[\u0e00-\\x{10FFFF}]"


def words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits; in unspaced scripts of every character."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.when(lowered.rlike(BEYOND), F.regexp_replace(lowered, f"({UNSPACED})", " $1 ")).otherwise(lowered)
    parts = F.split(spaced, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


_LONGS = "array<bigint>"


class Kind:
    """A way to hash words at every position of a text: the words at some places, under a number of their own."""

    def __init__(self, number: int, places: tuple[int, ...], span: int) -> None:
        self.number, self.places, self.span = number, places, span

    def at(self, w: Column, i: Column) -> Column:
        return F.xxhash64(F.lit(self.number), *[F.get(w, i + o) for o in self.places])

    def count(self, n: Column) -> Column:
        return F.greatest(n - (self.span - 1), F.lit(0))

    def seeds(self, w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - self.span), lambda i: self.at(w, i))
        return F.when(F.size(w) >= self.span, every).otherwise(F.array().cast(_LONGS))


class Alone(Kind):
    """One hash of all words of a text of fewer than ``PASSAGE``."""

    def __init__(self) -> None:
        super().__init__(-1, (), 1)

    def count(self, n: Column) -> Column:
        return ((n > 0) & (n < PASSAGE)).cast("int")

    def seeds(self, w: Column) -> Column:
        return F.when(self.count(F.size(w)) > 0, F.array(F.xxhash64(F.lit(-1), w))).otherwise(F.array().cast(_LONGS))


MASK_KINDS = [Kind(n, mask, SPAN) for n, mask in enumerate(MASKS)]


def run_of(length: int) -> Kind:
    return Kind(100 + length, tuple(range(length)), length)


def _placed(df: DataFrame, keys: list[str], w: Column, kinds: list[Kind]) -> DataFrame:
    """(keys, at, seed): a row per kind and position; plain numbers, since there is one for every word."""
    found = df.select(
        *keys, let(w, lambda x: F.struct(F.size(x).alias("n"), F.concat(*[k.seeds(x) for k in kinds]).alias("seeds"))).alias("s")
    ).select(*keys, F.col("s.n").alias("n"), F.posexplode("s.seeds").alias("k", "seed"))
    start, at = F.lit(0), None
    for kind in kinds:
        behind = start + kind.count(F.col("n"))
        here = F.col("k") - start
        at = F.when(F.col("k") < behind, here) if at is None else at.when(F.col("k") < behind, here)
        start = behind
    return found.select(*keys, at.alias("at"), "seed")


def _item_seeds(known: DataFrame) -> DataFrame:
    """(item_id, item_at, seed): by masks from 13 words on, by halves from 8, by all words below."""
    w, n, found = F.col("w"), F.size("w"), None
    for length in range(PASSAGE, WINDOW):
        half = length // 2 if length >= ONE_CHANGE else length
        parts = [F.struct(F.lit(0).alias("at"), run_of(half).at(w, F.lit(0)).alias("seed"))]
        if half < length:
            parts.append(F.struct(F.lit(half).alias("at"), run_of(length - half).at(w, F.lit(half)).alias("seed")))
        found = F.when(n == length, F.array(*parts)) if found is None else found.when(n == length, F.array(*parts))
    alone = F.struct(F.lit(0).alias("at"), F.xxhash64(F.lit(-1), w).alias("seed"))
    short = known.where(n < WINDOW).select(
        "item_id", F.inline(found.otherwise(F.array(alone)))
    )
    long = _placed(known.where(n >= WINDOW), ["item_id"], w, MASK_KINDS)
    return long.unionByName(short).select("item_id", F.col("at").alias("item_at"), "seed")


def _kinds(known: DataFrame) -> list[Kind]:
    """What documents must be hashed by: the masks, runs of some lengths (at most 4), whole short texts."""
    sizes = {r[0] for r in known.select(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).distinct().collect()}
    runs = {h for n in sizes if ONE_CHANGE <= n < WINDOW for h in (n // 2, n - n // 2)}
    runs |= {n for n in sizes if PASSAGE <= n < ONE_CHANGE}
    return MASK_KINDS * (WINDOW in sizes) + [run_of(n) for n in sorted(runs)] + [Alone()] * any(n < PASSAGE for n in sizes)


def items(benchmark: DataFrame) -> DataFrame:
    """(item_id, w): benchmark items with a word, equal ones once under their least id."""
    return (
        benchmark.select("item_id", words(F.col("text")).alias("w"))
        .where(F.size("w") > 0)
        .groupBy("w")
        .agg(F.min("item_id").alias("item_id"))
        .select("item_id", "w")
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item that it holds.

    Columns: doc_id, text_hash (xxhash64 of the text), item_id (least id of equal items), n_equal (equal words along
    the best alignment), n_words (of the item), window_equal (most equal words in a run of 13).

    An item of 13 words or more is held if 11 of 13 words in a row are; one of 8 to 12 words if all or all but one are; one
    of 4 to 7 if all are; a shorter one if the document has no other words. Null and empty texts and items hold
    nothing and are held by nothing. Rows that repeat a doc_id, null ids too, are compared each by its own text, and
    fully equal rows give one row. Empty tables give no rows. Columns other than doc_id and text, item_id and text are
    ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text")
    known = saved(items(benchmark.select("item_id", "text")), "items")
    # Without items nothing is searched for; a kind keeps the plan whole.
    kinds = _kinds(known) or [Alone()]
    seeds = small_or_shuffled(_item_seeds(known), BROADCAST_ROWS)
    placed = _placed(
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), ["doc_id", "text_hash"], words(F.col("text")), kinds
    )
    hits = saved(
        placed.join(seeds, "seed")
        .select("doc_id", "text_hash", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct(),
        "hits",
    )
    ids = small_or_shuffled(hits.select(F.col("doc_id").alias("hit")).distinct(), BROADCAST_ROWS)
    suspects = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("hit")), "left_semi").select(
        F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"), words(F.col("text")).alias("dw")
    ).distinct()
    pairs = hits.join(suspects, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).join(
        small_or_shuffled(known, BROADCAST_ROWS // 10), "item_id"
    )
    equal = F.transform(
        "w", lambda x, j: F.coalesce((F.get("dw", j + F.col("shift")) == x).cast("int"), F.lit(0))
    )
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    runs = lambda e: F.array_max(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(e) - (WINDOW - 1), F.lit(1))),
            lambda i: total(F.slice(e, i, WINDOW)),
        )
    )
    compared = pairs.select(
        "doc_id", "text_hash", "item_id", F.size("w").alias("n_words"), F.size("dw").alias("n_text"),
        let(equal, lambda e: F.struct(total(e).alias("n_equal"), runs(e).alias("window_equal"))).alias("c"),
    )
    n, same = F.col("n_words"), F.col("c.n_equal")
    return (
        compared.where(
            F.when(n >= WINDOW, F.col("c.window_equal") >= WINDOW_EQUAL)
            .when(n >= ONE_CHANGE, same >= n - 1)
            .otherwise((same == n) & ((n >= PASSAGE) | (F.col("n_text") == n)))
        )
        .groupBy("doc_id", "text_hash", "item_id", "n_words")
        .agg(F.max("c.n_equal").alias("n_equal"), F.max("c.window_equal").alias("window_equal"))
        .select("doc_id", "text_hash", "item_id", "n_equal", "n_words", "window_equal")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.

    Rows are judged as in ``leaks``, each by its own text: null, empty and wordless texts stay, repeated rows stay or go
    together, whatever their ids. With an empty benchmark all stay; an empty table stays empty.
    """
    found = saved(
        leaks(docs, benchmark).select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct(),
        "leaks",
    )
    return docs.join(
        small_or_shuffled(found, BROADCAST_ROWS),
        F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t")),
        "left_anti",
    )
