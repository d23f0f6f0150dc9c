"""Multi-party perspective rotation: each dialogue once for every participant.

The participant at hand speaks as the assistant, everybody else as a named user, system messages stay what they are.
Only what the participant says, with the marker that ends it, is a target; the masks give these spans in characters.

A rendered dialogue is cut into blocks of 64 turn numbers, so that no task holds a whole long dialogue, and every block
into pieces of ``MAX_MESSAGES`` messages in their order: the message of rank r in its block, from 0, is in sub_block
r // MAX_MESSAGES, so the pieces in order are the block. Ranks are found only where there can be a second piece. Messages
are gathered once per block and only multiplied by the participants when they are rendered. All of it is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import saved, shuffle_width, small_or_shuffled

BLOCK_TURNS = 64
MAX_MESSAGES = 4096
BROADCAST_ROWS = 200_000
SYSTEM = "system"
END = "<|end|>"


def _name(role: Column) -> Column:
    return F.regexp_replace(F.coalesce(role, F.lit("unknown")), r"[|<>\r\n]", "_")


def _render(messages: Column, speaker: Column) -> Column:
    """A struct of text, spans and counts for sorted messages."""
    pieces = F.transform(
        messages,
        lambda m: F.struct(
            F.when(m["role"] == SYSTEM, F.lit("<|system|>\n"))
            .when(m["role"] == speaker, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), _name(m["role"]), F.lit("|>\n"))).alias("head"),
            F.concat(F.replace(m["text"], F.lit("<|"), F.lit("<\\|")), F.lit(END)).alias("body"),
            F.coalesce(m["role"] == speaker, F.lit(False)).alias("own"),
        ),
    )
    nothing = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
    )

    def step(a: Column, p: Column) -> Column:
        start = a["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        return F.struct(
            (end + 1).alias("at"),
            F.when(p["own"], F.concat(a["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))))
            .otherwise(a["spans"]).alias("spans"),
        )

    return F.transform(
        F.array(pieces),
        lambda ps: F.struct(
            F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
            F.aggregate(ps, nothing, step)["spans"].alias("targets"),
            F.size(ps).cast("long").alias("n_messages"),
        ),
    )[0]


def _same_block(b: str, c: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col(c)) & F.col("block").eqNullSafe(F.col(b))


def _ranked(messages: DataFrame, max_messages: int) -> DataFrame:
    """Distinct messages with their sub_block; a block of any size lies in as many tasks as its rows fill.

    Rows are sorted over all tasks, so a rank is the place in the task plus what the block has in earlier tasks.
    """
    columns = ["conv_id", "block", "turn", "role", "text"]
    ordered = saved(
        messages.select(*columns).distinct()
        .repartitionByRange(shuffle_width(messages), *columns).sortWithinPartitions(*columns)
        .withColumn("at", F.monotonically_increasing_id()),
        "ordered-messages",
    )
    task = F.shiftright("at", 33)
    shares = ordered.groupBy("conv_id", "block", task.alias("task")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id", "block").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begun = shares.select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("task").alias("t"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    rank = F.col("at") + F.col("shift")
    return ordered.join(
        small_or_shuffled(begun, BROADCAST_ROWS), _same_block("b", "c") & (task == F.col("t"))
    ).select(*columns, F.floor(rank / max_messages).cast("long").alias("sub_block"))


def rotate(conversations: DataFrame, block_turns: int = BLOCK_TURNS, max_messages: int = MAX_MESSAGES) -> DataFrame:
    """One row per dialogue, participant and block: conv_id, speaker, block, sub_block, text, targets, n_messages.

    Messages are ordered by turn, then role, then text; a null turn comes first, in a block of its own. Rows that
    repeat all four columns are one message. A null text is an empty message. A null role is a user named ``unknown``
    and, like ``system``, no participant, so a dialogue of such messages alone gives no rows. A null conv_id is one
    dialogue. Markers inside a text are escaped (``<|`` becomes ``<\\|``). An empty table gives no rows; other columns
    are ignored. ``targets`` are character spans of ``text``; the pieces of a block in order of sub_block are its text.
    """
    rows = conversations.select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / block_turns).cast("long").alias("block"),
    )
    # Rows count repeats, so these are all blocks that can have a second piece; elsewhere every rank is in the first.
    crowded = saved(
        rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_messages)
        .select(F.col("conv_id").alias("c"), F.col("block").alias("b")),
        "crowded",
    )
    whole = F.lit(0).cast("long").alias("sub_block")
    if crowded.isEmpty():
        placed = rows.select("*", whole)
    else:
        large = small_or_shuffled(crowded, BROADCAST_ROWS)
        placed = rows.join(large, _same_block("b", "c"), "left_anti").select("*", whole).unionByName(
            _ranked(rows.join(large, _same_block("b", "c"), "left_semi"), max_messages)
        )
    blocks = placed.groupBy("conv_id", "block", "sub_block").agg(
        F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("messages")
    )
    speakers = (
        conversations.where(F.col("role").isNotNull() & (F.col("role") != SYSTEM))
        .select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    )
    joined = blocks.join(
        small_or_shuffled(speakers, BROADCAST_ROWS), F.col("conv_id").eqNullSafe(F.col("c"))
    )
    return joined.select(
        "conv_id", "speaker", "block", "sub_block", _render(F.col("messages"), F.col("speaker")).alias("r")
    ).select("conv_id", "speaker", "block", "sub_block", "r.text", "r.targets", "r.n_messages")


def digests(rotated: DataFrame) -> DataFrame:
    """The rendered rows as counts, the text's MD5 and the spans as text."""
    length = F.aggregate("targets", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    spans = F.array_join(
        F.transform("targets", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return rotated.select(
        "conv_id", "speaker", "block", "sub_block", "n_messages",
        F.size("targets").cast("long").alias("n_own"),
        F.length("text").cast("long").alias("n_chars"),
        length.alias("n_target_chars"),
        F.md5("text").alias("text_md5"),
        spans.alias("targets"),
    )
