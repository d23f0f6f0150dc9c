"""Quality rules whose limits follow the corpus: quantile sketches per language and source.

Fixed base rules need only the text. The further limits come from mergeable quantile sketches: per
(lang, source, metric) a histogram with log-linear buckets (values below 64 exactly, above that 6
leading bits, so a quantile is off by at most 1 in 32). Sketches of sources add up to those of a language,
and these to that of the corpus. A group's limits come from its own sketch plus that of its language, scaled to the
weight of ``PRIOR`` documents; the language's has the corpus's in it with the same weight. So a source of any size is
judged by its own spread as far as it shows one, and no size changes the rule. A limit is a quartile plus three
interquartile ranges plus a slack, so it cuts outliers, not a fixed share.

Everything is DataFrame functions; sketches are grouped before the shuffle and the limits, one row per
language and source, are broadcast only after their number was counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwatch.llm.common import SPACES, let, saved, small_or_shuffled

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Documents of its language that a group's sketch is mixed with, in weight; and of the corpus, a language's.
PRIOR = 50
#: Limits beyond so many rows are joined by a shuffle instead of a broadcast.
BROADCAST_ROWS = 50_000

#: Metrics in thousandths with the slack of their limits, and whether there is a lower limit as well.
METRICS = {
    "word_length": (1500, True),
    "symbol_share": (60, False),
    "upper_share": (200, False),
    "dup_line_share": (50, False),
    "repeat_share": (250, False),
}


def _repeated(words: Column) -> Column:
    """Words inside windows that occur twice or more."""
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
    )

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def places(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, k: F.coalesce(x["h"] == F.get(ordered, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(ordered, k + 1)["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def search(found: Column) -> Column:
        pairs = F.transform(found, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(
            let(F.sort_array(pairs), places)
        )

    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(hashes, search))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``__rules``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper.

    A null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    own = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        ),
    )
    return docs.withColumn("__rules", own)


def _metrics() -> dict[str, Column]:
    r = F.col("__rules")
    share = lambda part, whole: F.floor(1000 * part / F.greatest(whole, F.lit(1)))
    return {
        "word_length": share(r["word_chars"], r["n_words"]),
        "symbol_share": share(r["n_symbols"], r["word_chars"]),
        "upper_share": share(r["n_upper"], r["word_chars"]),
        "dup_line_share": share(r["n_dup_lines"], r["n_words"]),
        "repeat_share": share(r["n_repeat_words"], r["n_words"]),
    }


def bucket(value: Column) -> Column:
    """The least value of the log-linear bucket of a whole number from 0."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function(
        "shiftleft", F.call_function("shiftright", value.cast("long"), drop), drop
    )


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, metric, bucket, n): one histogram per group and metric; they merge by adding ``n``."""
    rows = measured.where("__rules.n_words > 0").select(
        "lang", "source",
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("metric"), bucket(value).alias("bucket"))
            for name, value in _metrics().items()
        ])).alias("m"),
    )
    return rows.groupBy("lang", "source", "m.metric", "m.bucket").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(histogram: DataFrame, prior: int) -> DataFrame:
    """(lang, source, metric, q1, q3) of the mixed sketches.

    A window here spans the buckets of the corpus's sketch of a metric, some thousand at most by its make.
    """
    whole = histogram.groupBy("metric", "bucket").agg(F.sum("n").alias("all_n"))
    lang = histogram.groupBy(F.col("lang").alias("l"), F.col("metric").alias("lm"), F.col("bucket").alias("lb")).agg(F.sum("n").alias("lang_n"))
    own = histogram.select(
        F.col("lang").alias("ol"), F.col("source").alias("os"), F.col("metric").alias("om"), F.col("bucket").alias("ob"),
        F.col("n").alias("own_n"),
    )
    grid = histogram.select("lang", "source", "metric").distinct().join(F.broadcast(whole), "metric")
    mixed = grid.join(
        own,
        F.col("lang").eqNullSafe(F.col("ol")) & F.col("source").eqNullSafe(F.col("os"))
        & (F.col("metric") == F.col("om")) & (F.col("bucket") == F.col("ob")),
        "left",
    ).join(
        lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("lm")) & (F.col("bucket") == F.col("lb")), "left"
    )
    by = Window.partitionBy("lang", "source", "metric")
    sums = {c: F.sum(F.coalesce(c, F.lit(0))) for c in ("own_n", "lang_n", "all_n")}
    upto = {c: s.over(by.orderBy("bucket")).cast("double") for c, s in sums.items()}
    total = {c: s.over(by).cast("double") for c, s in sums.items()}
    # A millionth of a document keeps quartiles that are met exactly from the rounding of the weights.
    mass = upto["own_n"] + F.lit(float(prior)) * (
        upto["lang_n"] + F.lit(float(prior)) * upto["all_n"] / total["all_n"]
    ) / (total["lang_n"] + prior) + F.lit(1e-6)
    first = lambda part: F.min(F.when(F.col("mass") * 4 >= part * (F.col("rows") + prior), F.col("bucket")))
    return (
        mixed.select("lang", "source", "metric", "bucket", mass.alias("mass"), total["own_n"].alias("rows"))
        .groupBy("lang", "source", "metric").agg(first(1).alias("q1"), first(3).alias("q3"))
    )


def limits(histogram: DataFrame, prior: int = PRIOR) -> DataFrame:
    """(lang, source, limits): a map from metric to its least and greatest accepted value."""
    slack = F.create_map(*[F.lit(x) for name, (s, _) in METRICS.items() for x in (name, s)])
    lower = F.create_map(*[F.lit(x) for name, (_, b) in METRICS.items() for x in (name, b)])
    chosen = _quartiles(histogram, prior)
    reach = 3 * (F.col("q3") - F.col("q1")) + slack[F.col("metric")]
    return chosen.groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct(
            "metric",
            F.struct(
                F.when(lower[F.col("metric")], F.col("q1") - reach).alias("least"),
                (F.col("q3") + reach).alias("most"),
            ),
        ))).alias("__limits")
    )


def judge(measured: DataFrame, counted: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Measured rows with ``__failed`` (base rules) and ``__kept``, by the limits of the ``counted`` rows."""
    found = saved(limits(saved(sketches(counted), "sketches"), prior), "limits")
    side = small_or_shuffled(
        found.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), "__limits"),
        BROADCAST_ROWS,
    )
    r, most = F.col("__rules"), F.col("__limits")
    failed = (r["n_words"] < MIN_WORDS) | (
        100 * r["n_repeat_words"] > MAX_REPEAT_PERCENT * r["n_words"]
    )
    inside = F.lit(True)
    for metric, value in _metrics().items():
        inside = inside & (value <= most[metric]["most"])
        if METRICS[metric][1]:
            inside = inside & (value >= most[metric]["least"])
    joined = measured.join(
        side,
        F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")),
        "left",
    )
    # Short texts have failed already, so no share is taken of nothing.
    return joined.withColumn("__failed", failed).withColumn(
        "__kept", F.when(F.col("__failed"), False).otherwise(F.coalesce(inside, F.lit(False)))
    )


def verdicts(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per document with its counts, base_failed and kept.

    A null or empty text, or one without words, has zero counts and fails. Null languages or sources are
    groups of their own. Repeated rows are judged each, ties in a sketch share a bucket, and an empty
    table gives no rows. Columns other than doc_id, text, lang and source are ignored.
    """
    counted = saved(measure(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measured")
    judged = judge(counted, counted, prior)
    return judged.select(
        "doc_id",
        *[F.col("__rules")[c].alias(c) for c in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def accepted(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, judged as in ``verdicts``.

    Null, empty and wordless texts go, as they fail the base rules; rows that repeat stay or go together; null languages and
    sources are groups of their own; an empty table stays empty; further columns, whatever their names, are kept as they are.

    The limits need all rows before the first one can be judged. Texts are measured a second time then, which
    leaves no copy of them behind and moves none.
    """
    counted = saved(measure(docs.select("text", "lang", "source")).drop("text"), "measured")
    return judge(measure(docs), counted, prior).where("__kept").select(*docs.columns)
