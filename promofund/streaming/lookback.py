"""Look-back refresh.

J1/J2 (batch): a date-partitioned table is refreshed by recomputing only the
partitions a run's look-back window touches, or chunk by chunk for a
back-fill; both must equal a full rebuild.

J3 (stream): the same "newest version per key" as Structured Streaming: each
micro-batch of a file stream is merged into the key buckets it touches, with the
batch's id as the table's version (idempotent on retry); late rows are merged
like any other.

J4: a table rebuilt in full once a day and over a look-back window in between.
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions.windows import LoadMode
from promofund.operators.dedup import top1
from promofund.session import checkpoint_dir
from promofund.sources.sinks import materialize, replace_partitions, scratch_path
from promofund.sources.versions import VersionedTable


def refresh(build: Callable[[LoadMode], DataFrame], path: str, partition_by: str, mode: LoadMode) -> None:
    """One run: rebuild the rows ``mode`` selects and replace their partitions."""
    replace_partitions(build(mode), path, [partition_by])


def backfill_chunks(start: _dt.date, end: _dt.date, months: int = 12) -> list[LoadMode]:
    """Month-aligned back-fill chunks covering [start, end]."""
    out, lo = [], start.replace(day=1)
    while lo <= end:
        y, m = divmod(lo.month - 1 + months, 12)
        nxt = _dt.date(lo.year + y, m + 1, 1)
        out.append(LoadMode(mode="backfill", backfill_start=lo, backfill_end=nxt - _dt.timedelta(days=1)))
        lo = nxt
    return out


# Buckets of a merged table: a batch rewrites only those its keys fall in.
MERGE_BUCKETS = 64


def latest_stream(spark: SparkSession, source: str, keys: Sequence[str], ts: str, tie_break: Sequence[str] = (),
                  target: str | None = None, max_files: int | None = None, buckets: int = MERGE_BUCKETS) -> VersionedTable:
    """Stream ``source`` (a parquet file, or a folder of part files) into a
    table holding the newest row per ``keys``; returns the merged table. Runs
    with ``availableNow`` so it processes what is there and stops.

    The table is partitioned by key bucket. A micro-batch reads and rewrites the
    buckets its own keys fall in and commits by a manifest, so its cost follows
    the keys it brings, not the table; a repeated batch starts from the version
    before it again. Every row reaches the merge, however late it comes:
    re-delivered rows, ties and old rows lose there by the same order as in the
    batch job, so the result does not depend on how rows are spread over files
    and micro-batches. Choose ``buckets`` so that one holds a few files' worth.
    """
    schema = spark.read.parquet(source).schema
    target = target or scratch_path(spark, "latest")
    ckpt = os.path.join(checkpoint_dir(spark), "streams", os.path.basename(target))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(source)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if path.getFileSystem(conf).getFileStatus(path).isFile():
        reader, source = reader.option("pathGlobFilter", os.path.basename(source)), os.path.dirname(source)
    # event time is an instant (TIMESTAMP); files written without a time zone
    # read as TIMESTAMP_NTZ, interpreted here in the session zone (UTC)
    stream = reader.parquet(source).withColumn(ts, F.col(ts).cast("timestamp"))
    stream = stream.withColumn("key_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    table = VersionedTable(spark, target, "key_bucket", stream.schema)
    order = [F.col(ts).desc_nulls_last()]
    ties = [F.col(c).desc() for c in tie_break]

    def merge(batch: DataFrame, batch_id: int) -> None:
        # each batch keeps one row a key before it meets the table
        new = materialize(top1(batch, list(keys), order, ties))
        touched = [str(r.key_bucket) for r in new.select("key_bucket").distinct().collect()]  # at most ``buckets``
        current = table.read_parts(touched, before=batch_id)
        both = new if current is None else current.unionByName(new)
        table.commit(top1(both, list(keys), order, ties).repartition("key_bucket"), batch_id, replaced=touched)
        table.vacuum()

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return table


def order_headers(spark: SparkSession, sf_dir: str, since: _dt.date | None = None) -> DataFrame:
    """The clean order-header table refreshed by look-back runs; ``since`` bounds
    the scan of the orders itself."""
    from promofund.sources import domain
    from promofund.sources.tables import scan
    orders = scan(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(_dt.datetime.combine(since, _dt.time())).cast("timestamp_ntz"))
    ent = domain.entities(spark, sf_dir)
    return (orders.join(ent, orders.o_custkey == ent.c_custkey)
            .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
                    F.trunc(F.col("o_orderdate").cast("date"), "month").alias("order_month"),
                    "global_entity_id",
                    F.concat(F.lit("W"), (F.col("o_custkey") % 5).cast("string")).alias("warehouse_id"),
                    "o_totalprice"))


def incremental_refresh(spark: SparkSession, sf_dir: str, run_date: _dt.date = _dt.date(2001, 8, 1), chunk_months: int = 12) -> str:
    """A7 + J1 + J2: the month-partitioned header table built by month-aligned
    back-fill chunks and then an incremental look-back run (B5b: month-grain
    bounds, so whole month partitions are recomputed). Returns its folder."""
    src = order_headers(spark, sf_dir)
    path = scratch_path(spark, "orders_inc")
    bounds = src.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    if bounds["lo"] is None:
        replace_partitions(src, path, ["order_month"])
        return path
    for chunk in backfill_chunks(bounds["lo"], bounds["hi"], chunk_months):
        refresh(lambda m: src.where(m.predicate("order_date")), path, "order_month", chunk)
    look_back = LoadMode(mode="incremental", run_date=run_date, look_back_days=7, month_grain=True)
    refresh(lambda m: src.where(m.predicate("order_month")), path, "order_month", look_back)
    return path


def two_speed_mode(run_at: _dt.datetime, look_back_days: int = 180, full_refresh_hour: int = 0) -> LoadMode:
    """The catalogue's two-speed refresh — every few hours only rows of
    the last ``look_back_days`` days are rebuilt; the run at
    ``full_refresh_hour`` rebuilds everything once a day."""
    if run_at.hour == full_refresh_hour:
        return LoadMode(mode="full")
    return LoadMode(mode="incremental", run_date=run_at.date(), look_back_days=look_back_days)


def refresh_two_speed(table: VersionedTable, build: Callable[[_dt.date | None, _dt.datetime], DataFrame], run_at: _dt.datetime,
                      look_back_days: int = 180, full_refresh_hour: int = 0) -> LoadMode:
    """One run. ``build(since, run_at)`` gives the rows as of ``run_at`` from
    the day ``since`` on (None: all); the table's partition column is a month.

    The full run replaces every partition; a run between reads and rebuilds
    whole months from that of its look-back on and keeps the other months' files.
    Either way readers switch to the new version at once, by its manifest."""
    mode = two_speed_mode(run_at, look_back_days, full_refresh_hour)
    version = int(run_at.timestamp())
    if mode.mode == "full":
        table.commit(build(None, run_at), version)
    else:
        since = (run_at.date() - _dt.timedelta(days=look_back_days)).replace(day=1)
        table.commit(build(since, run_at), version, replaced=[p for p in table.manifest(before=version) if p >= since.isoformat()])
    table.vacuum()
    return mode


def two_speed_headers(spark: SparkSession, sf_dir: str, runs: Sequence[_dt.datetime], root: str | None = None) -> VersionedTable:
    """The order headers kept up by ``runs`` of the two-speed refresh: a run sees
    the orders placed up to its day."""
    def build(since, run_at):
        rows = order_headers(spark, sf_dir, since)
        return rows.where(F.col("order_date") <= F.lit(run_at.date()))

    table = VersionedTable(spark, root or scratch_path(spark, "orders_two_speed"), "order_month", order_headers(spark, sf_dir).schema)
    for run_at in runs:
        refresh_two_speed(table, build, run_at)
    return table
