"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime settings every job here expects. They can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task holds must not grow with the tables, or it spills. Files and shuffles are
    # compressed: rows take some ten times as much while they are grouped and sorted.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Rows that come sorted are grouped as they come, in one step.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Partition directories hold STRING columns; inference would turn dt into DATE.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Streaming state outgrows the heap; RocksDB keeps it on disk and writes
    # only changes to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_spark(app_name: str = "tallyline", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings above; `conf` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(
    spark: SparkSession, *paths: str, bytes_each: int = 16 << 20, most: int | None = None
) -> int:
    """Start shuffles with enough partitions for the given inputs.

    Reads file sizes only. AQE joins partitions that turn out small, so the
    number may be generous; it is never set below the session's own.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    total = files.load(list(paths)).agg(F.sum("length")).first()[0] or 0
    wanted = math.ceil(total / bytes_each)
    if most:
        wanted = min(most, wanted)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > usual:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    else:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    return max(wanted, usual)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`.

    A local folder is made only in local mode without that setting (tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.gettempdir(), f"tallyline-{spark.sparkContext.applicationId}")


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/tallyline/{name}-{uuid.uuid4().hex}"
