"""A keyed feature store on shared storage: buckets, versions, merges of the newest value.

A version is a folder with one snapshot of all keys, cut into buckets by a hash of the key. A micro-batch merges its newest
rows into the buckets that it touches; the other buckets of a version point to the files of the one before. What a version
consists of is one small file, written last and never changed, so that a reader sees a whole version or none, and a batch
that is repeated finds its version there and does nothing. ``compact`` removes files that no kept version names.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16


@dataclass(frozen=True)
class Store:
    """A store at ``path``: rows of ``key`` and other columns, of which that with the greatest ``newest`` counts."""

    spark: SparkSession
    path: str
    key: str
    newest: Sequence[str]
    buckets: int = BUCKETS

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        where, fs = self._fs(f"{self.path}/versions")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(where)) if fs.exists(where) else []

    def parts(self, version: int | None = None) -> dict[int, str]:
        """Bucket to folder of a version, the last one by default."""
        known = self.versions()
        version = (known[-1] if known else None) if version is None else version
        if version is None:
            return {}
        found = json.loads(self.spark.read.text(f"{self.path}/versions/{version}").first()[0])
        return {int(k): v for k, v in found.items()}

    def _publish(self, version: int, parts: dict[int, str]) -> None:
        """The list of a version appears under its name in one step."""
        text = json.dumps({str(k): v for k, v in sorted(parts.items())})
        made = f"{self.path}/making/{version}"
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(made)
        self._fs(f"{self.path}/versions")[1].mkdirs(self._fs(f"{self.path}/versions")[0])
        source, fs = self._fs(made)
        target = self._fs(f"{self.path}/versions/{version}")[0]
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"version {version} is there already")

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None) -> DataFrame | None:
        """One row per key of a version; None while the store is empty. One version stays as it is, whatever comes after."""
        parts = self.parts(version)
        return self.spark.read.parquet(*[p for _, p in sorted(parts.items())]) if parts else None

    def merge(self, rows: DataFrame, version: int) -> bool:
        """Make ``version`` of the last one and ``rows``; False, and nothing done, if it is there.

        Rows without a key are left out. Of equal keys that with the greatest ``newest`` columns, then the greatest rest,
        stays, old or new.
        """
        known = self.versions()
        if known and version <= known[-1]:
            return False
        rows = rows.where(F.col(self.key).isNotNull())
        touched = [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]
        before = self.parts()
        old = [before[b] for b in touched if b in before]
        both = rows.unionByName(self.spark.read.schema(rows.schema).parquet(*old)) if old else rows
        rest = [c for c in rows.columns if c != self.key and c not in self.newest]
        top = F.max(F.struct(*self.newest, *rest)).alias("top")
        merged = both.groupBy(self.key).agg(top).select(self.key, *[F.col(f"top.{c}").alias(c) for c in rows.columns if c != self.key])
        made = f"{self.path}/data/{version}"
        (
            merged.select(*rows.columns).withColumn("__bucket", self.bucket())
            .repartition(max(1, len(touched)), "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(made)
        )
        self._publish(version, before | {b: f"{made}/__bucket={b}" for b in touched})
        return True

    def compact(self, keep: int = 2) -> int:
        """Forget all versions but the last ``keep`` and remove the folders that none of them names; gives their number."""
        known = self.versions()
        if not known:
            return 0
        for version in known[:-keep]:
            where, fs = self._fs(f"{self.path}/versions/{version}")
            fs.delete(where, True)
        named = {p for v in known[-keep:] for p in self.parts(v).values()}
        top, fs = self._fs(f"{self.path}/data")
        gone = 0
        for made in fs.listStatus(top) if fs.exists(top) else []:
            # What comes after the last version may be in the making.
            if int(made.getPath().getName()) > known[-1]:
                continue
            for part in fs.listStatus(made.getPath()):
                name = part.getPath().getName()
                if name.startswith("__bucket=") and f"{self.path}/data/{made.getPath().getName()}/{name}" not in named:
                    fs.delete(part.getPath(), True)
                    gone += 1
        return gone


def newest_per_key(batch: DataFrame, key: str, newest: Sequence[str]) -> DataFrame:
    """One row per key of a batch, so that a merge moves no more than that."""
    rest = [c for c in batch.columns if c != key and c not in newest]
    top = F.max(F.struct(*newest, *rest)).alias("top")
    return batch.groupBy(key).agg(top).select(key, *[F.col(f"top.{c}").alias(c) for c in batch.columns if c != key])


def feed(stream: DataFrame, store: Store, checkpoint: str) -> None:
    """Merge a stream into a store to its end, one version a micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.merge(newest_per_key(batch, store.key, store.newest), batch_id)

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()


def lookup(stream: DataFrame, store: Store, out: str, checkpoint: str, join) -> None:
    """Write ``join(batch, features)`` per micro-batch; a batch reads one version, the last when it begins.

    The version is noted before the batch is written, so that a repeated batch reads the same one.
    """
    spark = store.spark

    def write(batch: DataFrame, batch_id: int) -> None:
        noted = f"{out}/versions/{batch_id}"
        where, fs = store._fs(f"{noted}/_SUCCESS")
        if not fs.exists(where):
            spark.createDataFrame([(max(store.versions(), default=-1),)], "version long").coalesce(1).write.mode("overwrite").parquet(noted)
        version = spark.read.parquet(noted).first()[0]
        joined = join(batch, store.read(version if version >= 0 else None))
        joined.write.mode("overwrite").parquet(f"{out}/data/batch_id={batch_id}")

    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
