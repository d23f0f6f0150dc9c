"""The keyed store, late rows and rescued records."""

import json

from pyspark.sql import functions as F

from cardwatch import schemas
from cardwatch.operators import quality
from cardwatch.sources import requests
from cardwatch.streaming import late, store

ROW = "k string, at long, v double"


def frame(spark, *rows):
    return spark.createDataFrame(rows, ROW)


def content(df):
    return sorted(map(tuple, df.select("k", "at", "v").collect()))


def test_the_newest_row_of_a_key_stays(spark, tmp_path):
    s = store.Store(spark, f"{tmp_path}/s", "k", ["at"], buckets=4)
    assert s.read() is None and s.compact() == 0
    assert s.merge(frame(spark, ("a", 2, 1.0), ("b", 1, 1.0), ("a", 1, 9.0), (None, 5, 5.0)), 0)
    assert s.merge(frame(spark, ("a", 1, 7.0), ("b", 1, 3.0), ("c", 9, None)), 1)
    assert content(s.read()) == [("a", 2, 1.0), ("b", 1, 3.0), ("c", 9, None)]
    assert content(s.read(0)) == [("a", 2, 1.0), ("b", 1, 1.0)]


def test_a_repeated_batch_and_compaction_change_nothing(spark, tmp_path):
    s = store.Store(spark, f"{tmp_path}/s", "k", ["at"], buckets=3)
    batches = [frame(spark, *[(f"k{(i * 7 + b) % 20}", b, float(i)) for i in range(6)]) for b in range(6)]
    for b, rows in enumerate(batches):
        s.merge(store.newest_per_key(rows, "k", ["at"]), b)
    before, parts = content(s.read()), s.parts()
    assert not s.merge(batches[3], 3) and not s.merge(batches[5], 5) and s.parts() == parts
    open_view = s.read(4)
    assert s.compact(keep=2) > 0 and s.versions() == [4, 5]
    assert content(s.read()) == before and open_view.count() == s.read(4).count()
    assert s.compact(keep=2) == 0
    assert s.merge(frame(spark), 6) and content(s.read()) == before


def test_a_batch_that_failed_before_its_version_is_made_again(spark, tmp_path):
    s = store.Store(spark, f"{tmp_path}/s", "k", ["at"])
    s.merge(frame(spark, ("a", 1, 1.0)), 0)
    frame(spark, ("a", 9, 9.0)).withColumn("__bucket", F.lit(0)).write.partitionBy("__bucket").parquet(f"{s.path}/data/1")
    assert content(s.read()) == [("a", 1, 1.0)]  # files without a version are not seen
    s.merge(frame(spark, ("a", 2, 2.0)), 1)
    assert content(s.read()) == [("a", 2, 2.0)]


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    schema = "id long, at timestamp"
    batches = [[(1, 100), (2, 5000)], [(3, 4401), (4, 4399), (5, None)], [(6, 9000), (7, 4000)], [(8, 4000), (9, 8400)]]
    want = {4: 1, 5: 1, 7: 2, 8: 3}
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "id long, s long").select("id", F.timestamp_seconds("s").alias("at"))
        df.coalesce(1).write.parquet(f"{tmp_path}/in/part{i}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/part*")
        found = late.split_late(stream, f"{tmp_path}/out")
    rows = spark.read.parquet(found.late)
    assert {r.id: r.batch_id for r in rows.collect()} == want
    assert {r.id for r in spark.read.parquet(found.in_time).collect()} == set(range(1, 10)) - set(want)
    marks = {r.batch_id: (r.n, r.n_late) for r in late.marks(spark, found).collect()}
    assert marks == {0: (2, 0), 1: (3, 2), 2: (2, 1), 3: (2, 1)}


def test_faulty_records_are_rescued_with_their_text(spark):
    good = {"transaction_id": "t1", "amount": 5.0, "velocity_1h": 1.0, "night_tx_ratio": 0.1, "V14": 0.0, "V17": 0.0, "timestamp": 7}
    bodies = [json.dumps(good), json.dumps(good | {"extra": [1, {"x": 2}]}), '{"transaction_id": "cut', "", None, "[1, 2]", "7", "null",
              json.dumps(good | {"amount": "high"}), json.dumps(good | {"amount": -5.0}), json.dumps({"amount": 3.0})]
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    read = requests.ingest(df)
    faults = {r.body: r.fault for r in read.collect() if r.fault}
    assert faults == {b: "malformed" for b in ('{"transaction_id": "cut', "", None, "[1, 2]", "7", "null")} | {bodies[8]: "wrong_type"}
    taken, rescued = quality.route(read)
    assert taken.count() == 2 and taken.columns == [f.name for f in schemas.REQUEST.fields]
    reasons = [r.reasons for r in rescued.collect()]
    assert len(reasons) == 9 and reasons.count(["malformed"]) == 6 and ["wrong_type"] in reasons
    assert all("missing" in x or "amount" in x for r in reasons if len(r) > 0 and r[0] not in ("malformed", "wrong_type") for x in r)
    assert requests.ingest(df.limit(0)).count() == 0
