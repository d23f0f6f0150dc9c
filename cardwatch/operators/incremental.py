"""Rebuild of a date-partitioned gold table for changed days only.

A row changes the features of rows up to a frame later, and those need the rows up to a frame before them. So from the
changed days follow the days to recompute and the days to read; nothing else is read or written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.operators import gold
from cardwatch.sources import lake

Range = tuple[dt.date, dt.date]

#: Days that the longest frame of the gold features reaches back.
FRAME_DAYS = -(-gold.DAYS_30 // 86_400)


def ranges(days: Iterable[dt.date], before: int, after: int) -> list[Range]:
    """The days from ``before`` days before to ``after`` days after each of ``days``, joined where they touch."""
    out: list[Range] = []
    for day in sorted(set(days)):
        start, end = day - dt.timedelta(before), day + dt.timedelta(after)
        if out and start <= out[-1][1] + dt.timedelta(1):
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def within(days: list[Range], without_day: bool) -> Column:
    """A condition on the partition column alone, so that only these folders are listed and read."""
    day = F.col(lake.PARTITION)
    found = day.isNull() if without_day else F.lit(False)
    for start, end in days:
        found = found | day.between(F.lit(start), F.lit(end))
    return found


def changed_days(delivery: DataFrame) -> list[dt.date | None]:
    """The days of a delivery; one value a day reaches the driver. Rows without a day count as one day."""
    return [r[0] for r in delivery.select(lake.PARTITION).distinct().collect()]


def source_rows(source: DataFrame, changed: Iterable[dt.date | None], frame_days: int = FRAME_DAYS) -> DataFrame:
    """The rows that the features of the changed days, and of those that depend on them, are made from."""
    changed = set(changed)
    return source.where(within(ranges(changed - {None}, frame_days, frame_days), None in changed))


def rebuild(
    source: DataFrame,
    gold_path: str,
    changed: Iterable[dt.date | None],
    features: Callable[[DataFrame], DataFrame] = gold.compute_features,
    frame_days: int = FRAME_DAYS,
) -> list[Range]:
    """Bring the gold table at ``gold_path`` up to date after ``changed`` days of ``source``; gives the days written.

    ``source`` is a date-partitioned table. The days from a changed one to a frame behind it are recomputed and replace
    their folders as they are written; a day that has lost all its rows loses its folder. Running it again
    changes nothing. Rows without a day form a folder of their own. Without changed days nothing happens.
    """
    changed = set(changed)
    if not changed:
        return []
    written = ranges(changed - {None}, 0, frame_days)
    mine = within(written, None in changed)
    lake.write_by_date(features(source_rows(source, changed, frame_days)).where(mine), gold_path)
    left = {r[0] for r in source.where(mine).select(lake.PARTITION).distinct().collect()}
    spark = source.sparkSession
    there = {r[0] for r in lake.read_lake(spark, gold_path).where(mine).select(lake.PARTITION).distinct().collect()}
    for day in there - left:
        drop_day(spark, gold_path, day)
    return written


def drop_day(spark: SparkSession, path: str, day: dt.date | None) -> None:
    """Remove the folder of one day."""
    name = "__HIVE_DEFAULT_PARTITION__" if day is None else day.isoformat()
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{lake.PARTITION}={name}")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
