"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "cardwatch", **conf: str) -> SparkSession:
    """Session for tests and benches; on a cluster use the session that spark-submit gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Small local tables: keep all cores busy where a stage computes more than it reads.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CARDWATCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder that ``spark.checkpoint.dir`` names.

    Every executor must reach the folder, so a machine-local folder is made up
    only for a local master.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cardwatch-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/cardwatch/{name}-{uuid.uuid4().hex}"
