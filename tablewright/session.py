"""Spark sessions, and the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings for a large cluster; pass them to spark-submit or the session builder.
# AQE starts from many small shuffle partitions and merges them to the advisory
# size, so one setting serves small and large inputs alike, and it splits the hot
# side of a sort-merge join.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    # a bloom filter of a filtered side's keys goes before the other side's shuffle, if that side is
    # worth it; up to 256 MB of keys, some 100 million, in 64 MB
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "100000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int = 8, app: str = "tablewright") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for written tables, as named by ``spark.checkpoint.dir``.

    Only a local master may run without the setting; it then gets a temporary folder
    of its own, once per session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tablewright-{application}-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
