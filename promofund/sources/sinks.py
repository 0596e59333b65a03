"""Sinks (A6–A8, A11).

Tables are written as parquet under a shared folder; every write is one Spark
job with the output committer's atomic rename, so a lost executor only
retries tasks. Scratch tables live under the cluster's checkpoint folder
(``spark.checkpoint.dir``), never on a machine-local path.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage at a job-step boundary, as the reference writes a table
    after every step.

    The rows are written once, as Parquet under the shared folder
    (``spark.checkpoint.dir``), and read back: later steps prune columns, push
    filters and know the table's size, and a lost executor re-reads files
    instead of recomputing upstream stages. The folder goes with the driver's JVM.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str], partition_by: Sequence[str] = (),
                    num_partitions: int | None = None) -> None:
    """Full replace, clustered by columns.

    Range-partitioning + a sort within each file gives every parquet file a
    narrow min/max on the cluster keys, so readers skip row groups. Low
    cardinality keys go to ``partition_by`` folders instead.
    """
    cols = [F.col(c) for c in cluster_by]
    out = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    out = out.sortWithinPartitions(*cols)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Incremental sink — only the partitions present in ``df`` are
    replaced (dynamic partition overwrite); the rest of the table stays."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def read_partitioned(spark: SparkSession, path: str, column: str, lo, hi) -> DataFrame:
    """Reading a partitioned table requires bounds on its partition
    column; literal bounds prune folders before any file is opened."""
    if lo is None or hi is None:
        raise ValueError(f"a filter on partition column {column!r} is required")
    return spark.read.parquet(path).where(F.col(column).between(F.lit(lo), F.lit(hi)))


def stamp(df: DataFrame, as_of: _dt.datetime, version: str | None = None) -> DataFrame:
    """Run stamps passed in explicitly (reruns stay identical)."""
    out = df.withColumn("ingested_at", F.lit(as_of))
    return out.withColumn("settlement_version", F.lit(version)) if version else out
