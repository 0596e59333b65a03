"""Spark session defaults for the settlement jobs.

Cluster settings (executors, memory) come from spark-submit; this module only
pins what changes results (UTC session time zone, ANSI) and turns on AQE so
joins and shuffles re-plan on the sizes measured at run time.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE: coalesce small shuffle partitions, split
# skewed join partitions, and switch a sort-merge join to a broadcast join when
# the materialised side turns out small.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the join's partitioning would otherwise
    # be reused by the following window (costs one extra shuffle only then)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # No broadcast by estimate: Spark's estimate of an exploded side is that of
    # its input, however many rows it makes. Adaptive execution broadcasts a side
    # after measuring its shuffled size; dimensions with a proven bound carry
    # explicit hints or are checked (operators/joins.py).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Runtime bloom filters re-scan one join side to pre-filter the other; in
    # these jobs the filtered side is the small rule/dimension side, so the
    # extra scan of the fact side costs more than it saves (T4: ~2x slower).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MAX_SHUFFLE_PARTITIONS = 50_000


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "promofund") -> SparkSession:
    """Build (or reuse) a session with the settlement defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("PROMOFUND_DRIVER_MEMORY", "16g"))
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the input files (file-system metadata, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffles(spark: SparkSession, paths, target_partition_bytes: int = 128 << 20,
                  expansion: float = 3.0) -> int:
    """Size ``spark.sql.shuffle.partitions`` from the input volume.

    Parquet expands roughly ``expansion`` times once decoded into shuffle
    rows; each reduce partition should hold about ``target_partition_bytes``
    so it sorts and aggregates in executor memory without spilling. AQE then
    coalesces small partitions and splits skewed ones around this starting
    point. Never goes below the cluster's default parallelism.
    """
    n_bytes = input_bytes(spark, paths)
    parts = max(spark.sparkContext.defaultParallelism, int(n_bytes * expansion / target_partition_bytes) + 1)
    # beyond this the driver's bookkeeping costs more than larger partitions do
    parts = min(parts, MAX_SHUFFLE_PARTITIONS)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes // 2))
    return parts


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written steps, named by ``spark.checkpoint.dir``.

    Only a local session (a test) without the setting gets a folder of its own;
    elsewhere a missing setting is an error, since the driver and the executors
    would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="promofund-steps-"))
    return spark.sparkContext.getCheckpointDir()
