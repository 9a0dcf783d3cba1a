"""Spark session and cluster-path helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "webfold", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Session tuned for this library: AQE (coalesce + skew join), UTC, Arrow.

    On a cluster the master and memory come from ``spark-submit``; ``master``
    is only set for local runs and tests.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # big html strings: keep Arrow batches small
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    if master and master.startswith("local"):
        # local runs only: the driver is the executor; deep plans need heap
        conf["spark.driver.memory"] = os.environ.get("WEBFOLD_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, read from ``spark.checkpoint.dir``.

    A cluster names a shared folder there.  Only a local master may leave it
    unset: driver and executors are then one process, and a fresh temporary
    folder serves; anywhere else that would be a folder of one machine, so it
    is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="webfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
