"""Trailing time frames per key: counts, means, deviations, distinct values, running scores.

A frame of ``seconds`` holds the rows of the same key whose time lies in
``[t - seconds, t]``, both ends and the current row included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.functions.moments import Moments, zscore
from cardwatch.operators.skew import equal_on


@dataclass(frozen=True)
class Trailing:
    """One output column: ``function`` of ``column`` over the frame.

    ``count``, ``avg`` and ``stddev`` as in SQL; ``share`` is the part of true values among the
    non-null ones of a boolean column.
    """

    alias: str
    function: str
    column: str
    seconds: int


INF = float("inf")


def _finite(c: Column) -> Column:
    """The value where it is a usual number, else null; NaN compares above all others."""
    x = c.cast("double")
    return F.when(F.abs(x) < INF, x)


#: Values that spoil a sum are counted by themselves instead, so that they only reach frames that hold them.
ODD = {
    "nan": lambda x: F.isnan(x),
    "up": lambda x: x == INF,
    "down": lambda x: x == -INF,
}


def _mean(finite: Column, nan: Column, up: Column, down: Column) -> Column:
    """The mean of all values from that of the finite ones and the numbers of the others."""
    return (
        F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan"))
        .when(up > 0, INF)
        .when(down > 0, -INF)
        .otherwise(finite)
    )


def _deviation(finite: Column, n: Column, nan: Column, up: Column, down: Column) -> Column:
    """The deviation of all values, ``n`` of them finite: undefined once another one is among them."""
    odd = nan + up + down
    return F.when(odd == 0, finite).otherwise(F.when(n + odd > 1, float("nan")))


def trailing(
    df: DataFrame, specs: Sequence[Trailing], key: str = "client_id", ts: str = "timestamp"
) -> DataFrame:
    """Add one column per spec, in work linear in the rows whatever the size of a key.

    Time is cut into blocks as long as a frame. A row leaves a copy in the block after its own, so a frame lies within the
    rows of one (key, block): one exchange and one sort by time serve all counts and shares, whatever their lengths, and
    one exchange each length of means and deviations. The rows travel along, so the input is read once and joined with
    nothing, and a task never holds more than the rows of two blocks of a key.

    NaN and infinities count as in SQL, but only in frames that hold them; nulls count nowhere. Rows without a
    time, or without a key, are each other's.
    """
    names = df.columns
    counted = [s for s in specs if s.function in ("count", "share")]
    if counted:
        df = _with_counts(df, counted, key, ts)
    measured = [s for s in specs if s.function in ("avg", "stddev")]
    for seconds in sorted({s.seconds for s in measured}):
        df = _with_moments(df, [s for s in measured if s.seconds == seconds], key, ts)
    return df.select(*names, *[s.alias for s in specs])


def _placed(df: DataFrame, terms: dict[str, Column], seconds: int, key: str, ts: str) -> DataFrame:
    """(k, t, e, terms, b, row): every row in its block, and without itself, as a copy, in the next one.

    ``e`` is the time of a row, or the last one whose frame holds a copy. The key travels as ``k`` only.
    """
    block, rest = F.floor(F.col(ts) / seconds), df.drop(key)
    places = F.array(
        F.struct(block.alias("b"), F.col(ts).alias("e"), F.struct(*rest.columns).alias("row")),
        F.struct((block + 1).alias("b"), (F.col(ts) + seconds).alias("e"), F.lit(None).cast(rest.schema).alias("row")),
    )
    return df.select(
        F.col(key).alias("k"), F.col(ts).alias("t"), *[c.alias(name) for name, c in terms.items()], F.inline(places)
    ).where(F.col("row").isNotNull() | F.col("t").isNotNull())


def _restored(df: DataFrame, key: str) -> list[Column]:
    """The columns of the row; the key is the one that was dealt by, so that a table laid out by it stays so."""
    return [F.col("k").alias(c) if c == key else F.col("row")[c].alias(c) for c in df.columns]


_BLOCK = ("k", "b")


def _with_counts(df: DataFrame, specs: Sequence[Trailing], key: str, ts: str) -> DataFrame:
    """Counts and shares: the running count at a row less that at the last row before its frame. Whole numbers, so exact."""
    terms = {f"n_{s.column}": F.col(s.column).isNotNull().cast("long") for s in specs}
    terms |= {f"true_{s.column}": F.coalesce(F.col(s.column).cast("long"), F.lit(0)) for s in specs if s.function == "share"}
    placed = _placed(df, terms, max(s.seconds for s in specs), key, ts)
    by_time = Window.partitionBy(*_BLOCK).orderBy("t")
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.select("k", "t", "b", "row", *[F.sum(name).over(upto).alias(name) for name in terms])

    def within(name: str, seconds: int) -> Column:
        before = F.last(name).over(by_time.rangeBetween(Window.unboundedPreceding, -(seconds + 1)))
        # Rows without a time have none before them.
        return F.col(name) - F.when(F.col("t").isNotNull(), F.coalesce(before, F.lit(0))).otherwise(0)

    def result(s: Trailing) -> Column:
        n = within(f"n_{s.column}", s.seconds)
        if s.function == "count":
            return n
        return F.try_divide(within(f"true_{s.column}", s.seconds).cast("double"), n)

    found = running.select("k", "row", *[result(s).alias(s.alias) for s in specs]).where(F.col("row").isNotNull())
    return found.select(*_restored(df, key), *[s.alias for s in specs])


def _with_moments(df: DataFrame, specs: Sequence[Trailing], key: str, ts: str) -> DataFrame:
    """Means and deviations over frames of one length.

    A frame is the tail of the block before, from t - W on, plus the head of the block of t. Tails are running sums of the
    copies, the last to leave a frame first, which a row reads off at its own time; heads are running sums forwards over
    the block's own rows. Both add up values of the frame alone, so nothing large is taken off again, and deviations are
    taken from the mean of their block, against cancellation. So there are two sorts: one of rows and copies, which carry one
    value a column, and one of the rows alone.
    """
    w = specs[0].seconds
    columns = sorted({s.column for s in specs})
    placed = _placed(df, {f"v_{c}": F.col(c).cast("double") for c in columns}, w, key, ts)
    sides = {"head": F.col("row").isNotNull(), "tail": F.col("row").isNull()}
    backwards = Window.partitionBy(*_BLOCK).orderBy(F.desc("e"))
    whole = backwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def finite(side: str, c: str) -> Column:
        return F.when(sides[side], _finite(F.col(f"v_{c}")))

    centred = placed.select(
        "k", "b", "e", "row", *[f"v_{c}" for c in columns],
        *[F.avg(finite(side, c)).over(whole).alias(f"{side}_centre_{c}") for c in columns for side in sides],
    )

    def sums(side: str, over) -> list[Column]:
        """What a side adds up: nothing of the other side's rows."""
        terms = {}
        for c in columns:
            x = finite(side, c)
            shift = x - F.col(f"{side}_centre_{c}")
            terms |= {f"f_{c}": x.isNotNull().cast("long"), f"sum_{c}": x, f"s1_{c}": shift, f"s2_{c}": shift * shift}
            terms |= {f"{name}_{c}": F.coalesce(odd(F.col(f"v_{c}")) & sides[side], F.lit(False)).cast("long") for name, odd in ODD.items()}
        return [F.coalesce(F.sum(term).over(over), F.lit(0).cast("double")).alias(f"{side}_{name}") for name, term in terms.items()]

    upto = (Window.unboundedPreceding, Window.currentRow)
    tails = centred.select("*", *sums("tail", backwards.rangeBetween(*upto))).where("row IS NOT NULL")
    both = tails.select("*", *sums("head", Window.partitionBy(*_BLOCK).orderBy("e").rangeBetween(*upto)))

    def total(name: str) -> Column:
        return F.col(f"head_{name}") + F.col(f"tail_{name}")

    def moments(side: str, c: str) -> Moments:
        n, s1, s2 = (F.col(f"{side}_{x}_{c}") for x in ("f", "s1", "s2"))
        mean = F.when(n > 0, F.col(f"{side}_centre_{c}") + s1 / n)
        return Moments(n, mean, F.when(n > 0, F.greatest(s2 - s1 * s1 / n, F.lit(0.0))).otherwise(0.0))

    def result(s: Trailing) -> Column:
        n, odd = total(f"f_{s.column}"), [total(f"{name}_{s.column}") for name in ODD]
        if s.function == "avg":
            return _mean(F.when(n > 0, total(f"sum_{s.column}") / n), *odd)
        return _deviation(moments("head", s.column).merge(moments("tail", s.column)).stddev(), n, *odd)

    return both.select(*_restored(df, key), *[result(s).alias(s.alias) for s in specs])


def trailing_distinct(
    df: DataFrame,
    specs: Sequence[tuple[str, str, int]],
    key: str = "client_id",
    ts: str = "timestamp",
) -> DataFrame:
    """Add, per ``(alias, column, seconds)``, the number of distinct values in the frame.

    An occurrence of a value covers the seconds from its own up to the value's next occurrence
    or the end of its frame, whichever is first. Spans of one value do not overlap, so the
    number of open spans at t is the number of distinct values in the frame of t.

    Time is cut into blocks as long as the frame. The next occurrence that matters is in the block of a row or the one
    after, and a span reaches into the block after at most, so rows and spans leave a copy there and no block needs
    another's result: two exchanges a spec, no join, and the rows themselves travel along, so the input is read once. No key
    needs a task of its own. Rows need a time.
    """
    for alias, c, seconds in specs:
        df = _with_distinct(df, alias, c, seconds, key, ts)
    return df


def _with_distinct(df: DataFrame, alias: str, column: str, seconds: int, key: str, ts: str) -> DataFrame:
    block = F.floor(F.col(ts) / seconds)
    # The copy in the block before tells the rows there of the next occurrence; a null is no value.
    places = F.array(
        F.struct(block.alias("b"), F.struct(*df.columns).alias("row")),
        F.struct((block - 1).alias("b"), F.lit(None).cast(df.schema).alias("row")),
    )
    placed = df.select(
        F.col(key).alias("k"), F.col(column).alias("v"), F.col(ts).alias("t"), F.inline(places)
    ).where(F.col("row").isNotNull() | (F.col("v").isNotNull() & F.col("t").isNotNull()))
    following = F.lead("t").over(Window.partitionBy("k", "b", "v").orderBy("t"))
    end = F.col("t") + seconds + 1
    rows = placed.select("k", "v", "t", "b", "row", F.least(end, F.coalesce(following, end)).alias("c")).where(F.col("row").isNotNull())
    there, border = F.col("v").isNotNull(), (F.col("b") + 1) * seconds
    closes_in = F.floor(F.col("c") / seconds)
    nothing = F.lit(None).cast(df.schema)

    def event(b: Column, t: Column, change: int, when: Column) -> Column:
        return F.when(there & when, F.struct(b.alias("b"), t.alias("t"), F.lit(change).alias("change"), nothing.alias("row")))

    own = F.struct(F.col("b").alias("b"), F.col("t").alias("t"), there.cast("int").alias("change"), F.col("row").alias("row"))
    events = rows.select(
        "k",
        F.inline(F.array_compact(F.array(
            own,
            event(F.col("b"), F.col("c"), -1, closes_in == F.col("b")),
            event(F.col("b") + 1, border, 1, F.col("c") > border),
            event(F.col("b") + 1, F.col("c"), -1, (F.col("c") > border) & (closes_in == F.col("b") + 1)),
        ))),
    )
    upto = Window.partitionBy("k", "b").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = events.select("k", "row", F.sum("change").over(upto).alias("n")).where(F.col("row").isNotNull())
    return counted.select(*_restored(df, key), F.col("n").cast("long").alias(alias))


def running_zscore(
    df: DataFrame,
    column: str = "amount",
    key: str = "client_id",
    ts: str = "timestamp",
    tie: str = "transaction_id",
    alias: str = "zscore_running",
    block_seconds: int = 86_400,
) -> DataFrame:
    """Add the z-score of ``column`` against all rows of the key so far, in (ts, tie) order.

    Rows are scanned per block of ``block_seconds`` and continued from the moments of the blocks
    before, which are one row each. NaN and infinities count as in SQL, from their row on.
    """
    rows = df.withColumn("_block", F.floor(F.col(ts) / block_seconds)).withColumn(
        "_finite", _finite(F.col(column))
    )
    w = (
        Window.partitionBy(key, "_block")
        .orderBy(ts, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select(
        "*",
        F.count("_finite").over(w).alias("_n"),
        F.avg("_finite").over(w).alias("_mean"),
        F.var_pop("_finite").over(w).alias("_var"),
        *[F.count_if(odd(F.col(column).cast("double"))).over(w).alias(f"_{x}") for x, odd in ODD.items()],
    )
    joined = equal_on(local, _moments_before(rows, column, key), [key, "_block"])
    both = Moments(
        F.coalesce("_n0", F.lit(0)), F.col("_mean0"), F.coalesce("_m20", F.lit(0.0))
    ).merge(
        Moments(F.col("_n"), F.col("_mean"), F.coalesce(F.col("_var") * F.col("_n"), F.lit(0.0)))
    )
    odd = [F.col(f"_{x}") + F.coalesce(f"_{x}0", F.lit(0)) for x in ODD]
    mean = _mean(F.when(both.n > 0, both.mean), *odd)
    score = zscore(F.col(column), mean, _deviation(both.stddev(), both.n, *odd))
    return joined.select(*[c for c in df.columns], score.alias(alias))


def _moments_before(df: DataFrame, column: str, key: str) -> DataFrame:
    """Moments of all blocks of the key before this one: one row per key and block."""
    blocks = df.groupBy(key, "_block").agg(
        F.count("_finite").alias("n"),
        F.avg("_finite").alias("mean"),
        F.coalesce(F.var_pop("_finite") * F.count("_finite"), F.lit(0.0)).alias("m2"),
        *[F.count_if(odd(F.col(column).cast("double"))).alias(x) for x, odd in ODD.items()],
    )
    whole = Window.partitionBy(key)
    centre = F.coalesce(
        F.try_divide(F.sum(F.col("n") * F.col("mean")).over(whole), F.sum("n").over(whole)),
        F.lit(0.0),
    )
    blocks = blocks.select("*", centre.alias("centre"))
    shift = F.coalesce(F.col("mean") - F.col("centre"), F.lit(0.0))
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.select(
        key,
        "_block",
        "centre",
        F.sum("n").over(earlier).alias("_n0"),
        F.sum(F.col("n") * shift).over(earlier).alias("s1"),
        F.sum(F.col("m2") + F.col("n") * shift * shift).over(earlier).alias("s2"),
        *[F.sum(x).over(earlier).alias(f"_{x}0") for x in ODD],
    )
    some = F.col("_n0") > 0
    return sums.select(
        key,
        "_block",
        "_n0",
        *[f"_{x}0" for x in ODD],
        F.when(some, F.col("centre") + F.col("s1") / F.col("_n0")).alias("_mean0"),
        F.when(some, F.col("s2") - F.col("s1") * F.col("s1") / F.col("_n0"))
        .otherwise(0.0)
        .alias("_m20"),
    )
