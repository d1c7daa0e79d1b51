"""Spark session defaults and the shared checkpoint folder.

Every operator in the package is a DataFrame -> DataFrame function; this module
only decides how a session is built when the caller does not bring one, and
where lineage is cut.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins from
# runtime sizes (broadcast when a side turns out small, split skewed
# partitions), and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of collected lineage-cut tables are removed with them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Shuffles are dealt into many partitions, which adaptive execution merges up to a size
# (of packed bytes; names and ids take some thirty times that in memory): a task's share
# does not grow with the tables, as it does where the number of partitions is set.
SHUFFLE_PARTITIONS = 1024
SHUFFLE_BYTES = 4 << 20
# What a task reads of a file: partial aggregates hold a group for nearly every row.
FILE_BYTES = 32 << 20


def bound_partitions(spark: SparkSession) -> None:
    """Keep what a task reads of a shuffle to ``SHUFFLE_BYTES``, for tables that fill up to
    ``SHUFFLE_PARTITIONS`` such parts, and of a file to ``FILE_BYTES``.  A larger number of
    partitions in the session stays."""
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(initial, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if now < SHUFFLE_PARTITIONS:
        spark.conf.set(initial, str(SHUFFLE_PARTITIONS))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_BYTES))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(FILE_BYTES))


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app_name: str = "shelfwise",
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local runs.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; we read it from the session and never invent a
    machine-local one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage for this cluster")
    local_dir = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("SHELFWISE_SCRATCH"))
    sc.setCheckpointDir(local_dir)
    return local_dir


# Called with every frame that is about to be cut, before its plan is replaced by a
# scan: lets audits see the plans that really run.
BEFORE_CUT: list[Callable[[DataFrame], None]] = []


# Spark deletes the shuffle files (and checkpoints) of frames that the driver has collected
# as garbage, which a driver with memory to spare may put off to the end.
COLLECT_AFTER_S = 5.0


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss.

    One that took ``COLLECT_AFTER_S`` is followed by a collection of the driver's garbage,
    so that the disk holds the shuffles of about one cut at a time, not of the whole query."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    for seen in BEFORE_CUT:
        seen(df)
    began = time.monotonic()
    cut = df.checkpoint(eager=True)
    if time.monotonic() - began >= COLLECT_AFTER_S:
        del df  # it refers to the shuffles of its plan
        free_shuffles(spark)
    return cut


def free_shuffles(spark: SparkSession) -> None:
    gc.collect()
    spark._jvm.System.gc()
