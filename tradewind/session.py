"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits skewed join partitions and coalesces small ones;
# broadcasts are left to Catalyst, which checks sizes against the threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(master: str = "local[*]", app: str = "tradewind", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cluster_settings(data_bytes: int, executors: int, cores: int, memory_gb: int) -> dict[str, str]:
    """Settings for a cluster, derived from the bytes that the largest shuffle may carry.

    Adaptive execution merges small partitions but cannot add any, so the
    initial number follows the data: 128 MB each, at least two per core.  A
    broadcast table is held by every executor next to its running tasks, so the
    limit stays a small part of the memory of one core.
    """
    slots = executors * cores
    partitions = max(2 * slots, -(-data_bytes // (128 << 20)))
    broadcast = min(256 << 20, (memory_gb << 30) // cores // 32)
    return {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
        "spark.sql.files.maxPartitionBytes": "256MB",
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # A filter may be made from a side whose keys still fit the filter's 64 MB at most.
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(8 * broadcast),
        "spark.sql.cbo.enabled": "true",
    }


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder on this machine;
    on a cluster the setting must name a folder every executor can reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tradewind-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write below the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
