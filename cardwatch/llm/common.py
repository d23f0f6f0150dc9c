"""What the operators of this subpackage share: written intermediate tables, bounded joins, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.session import scratch_path

#: Words are runs of anything but these characters.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: lineage ends here, losses do not hurt."""
    path = scratch_path(df.sparkSession, f"llm/{name}")
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.cardwatch_path = path
    return written


def discard(written: DataFrame) -> None:
    """Remove a table that ``saved`` wrote and that nothing will read again."""
    path = getattr(written, "cardwatch_path", None)
    if path:
        spark = written.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_or_shuffled(side: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only if ``side`` was counted and has at most ``rows`` rows."""
    return F.broadcast(side) if side.limit(rows + 1).count() <= rows else side


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``, so that lambdas in it do not compute it again."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z only, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unit_interval(*key: Column) -> Column:
    """A fixed pseudo-random double in [0, 1) for a key."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))
