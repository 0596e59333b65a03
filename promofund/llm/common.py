"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Bytes of rows that a Python step of ``save`` may be sent at a time.
BATCH = 2 << 20


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session (a test) without that setting gets a folder of its
    own; on a cluster a missing setting is an error, since executors would not
    see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-"))
    return spark.sparkContext.getCheckpointDir()


def save(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts the lineage at a step whose rows are used more than once: later scans
    prune columns, and after a lost executor they read files again instead of
    recomputing the steps before. The folder goes when the driver's JVM ends.

    ``batch``: about as many bytes of rows go to a Python step of ``df`` at a
    time (else Spark's 10,000 rows or 64 MB, which an executor holds several
    times: as Arrow vectors beside the heap, and in each worker).
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    if batch:
        spark.conf.set(setting, str(batch))
    try:
        df.write.parquet(path)
    finally:
        if batch:
            spark.conf.set(setting, before)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def beside(written: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """``written`` (from ``save``) for a join with large rows: broadcast while
    its files hold at most ``max_bytes``, else an ordinary shuffle join that
    adaptive execution can split."""
    n_bytes = int(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(written) if n_bytes <= max_bytes else written


def tidy(run):
    """``run`` (batches to batches), which hands freed memory back to the system
    when a task ends: Python workers wait for the next stage beside the JVM, and
    their pools would keep what the largest batch took."""
    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return tidied


def rank_buckets(n_rows: int) -> int:
    """Buckets that one key's rows are spread over: at least 1024, and about
    2,000 rows of the hottest possible key in each."""
    return max(1024, n_rows // 2000)


def running_totals(df: DataFrame, keys: list[str], order_hash: str, weight: Column, n_buckets: int,
                   out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same ``keys``
    that come before the row in the order (bucket, ``order_hash``).

    A key may hold any share of the rows. Its rows are dealt by their hash over
    ``n_buckets`` buckets; one aggregate (with map-side combine) sums each
    bucket, a window over these sums gives each bucket's offset, and a second
    window numbers the rows inside a bucket. No task ever holds a whole key.
    ``order_hash`` must be a long that differs between rows.
    """
    w = "__weight"
    b = "__bucket"
    rows = df.withColumn(w, weight.cast("long")).withColumn(b, F.pmod(F.col(order_hash), F.lit(n_buckets)))
    sums = rows.groupBy(*keys, b).agg(F.sum(w).alias("__sum"))
    over_buckets = W.partitionBy(*keys).orderBy(b).rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(b).alias("__b"),
                          F.coalesce(F.sum("__sum").over(over_buckets), F.lit(0).cast("long")).alias("__offset"))
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [F.col(b) == F.col("__b")]
    in_bucket = W.partitionBy(*keys, b).orderBy(order_hash).rowsBetween(W.unboundedPreceding, -1)
    return (rows.join(offsets, cond)
            .withColumn(out, F.col("__offset") + F.coalesce(F.sum(w).over(in_bucket), F.lit(0).cast("long")))
            .drop(w, b, "__b", "__offset", *[f"__k{i}" for i in range(len(keys))]))


def ranks(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``rank`` (long, from 0: the row's place by ``order`` among the rows of
    its ``groups``) and ``size`` (rows of the group). Nulls come first; rows that
    agree in ``groups`` and ``order`` are ranked as they lie in the files.

    A group may hold any share of the rows: one range shuffle sorts the rows
    over all partitions, and a row's place in its partition plus the counts of
    the group in earlier partitions is its rank. The counts have at most one
    row a partition and group. ``df`` should be a written table, as the range
    shuffle reads it twice.
    """
    at, part = "__at", "__part"
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*groups, *order, "__tie").sortWithinPartitions(*groups, *order, "__tie").drop("__tie")
    rows = save(rows.withColumn(at, F.monotonically_increasing_id()), name)
    rows = rows.withColumn(part, F.shiftrightunsigned(at, 33))
    runs = rows.groupBy(*groups, part).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__n"))
    over = W.partitionBy(*groups) if groups else W.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("__n").over(over.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    runs = runs.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(groups)], F.col(part).alias("__p"),
                       (before - F.col("__first")).alias("__shift"), F.sum("__n").over(over).alias("size"))
    same = [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(groups)] + [F.col(part) == F.col("__p")]
    return (rows.join(beside(save(runs, f"{name}-runs")), same)
            .withColumn("rank", F.col(at) + F.col("__shift"))
            .drop(at, part, "__p", "__shift", *[f"__g{k}" for k in range(len(groups))]))
