"""Versioned tables, the keyed stream merge and the two-speed refresh."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from promofund.operators.dedup import latest_per_key
from promofund.sources.sinks import scratch_path
from promofund.sources.versions import VersionedTable
from promofund.streaming import lookback


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _files(table):
    """Data files of the current version."""
    return {os.path.join(folder, f) for folder in table.manifest().values() for f in os.listdir(os.path.join(table.root, folder)) if f.endswith(".parquet")}


def test_partial_commit_keeps_other_files(spark):
    rows = spark.createDataFrame([(i, i % 4) for i in range(40)], "id int, part int")
    table = VersionedTable(spark, scratch_path(spark, "vt"), "part", rows.schema)
    assert table.read(0, 9).collect() == [] and table.versions() == []
    table.commit(rows, 1)
    before = _files(table)
    table.commit(rows.where("part = 2 and id > 20"), 2, replaced=["2", "3"])
    after = _files(table)
    assert {f for f in before if "part=0" in f or "part=1" in f} == {f for f in after if "v=1" in f}
    assert not any("part=3" in f for f in after)
    assert _rows(table.read(0, 9)) == _rows(rows.where("part < 2 or (part = 2 and id > 20)"))
    assert _rows(table.read(0, 9, version=1)) == _rows(rows)  # the old version is whole


def test_a_repeated_commit_starts_from_the_version_before(spark):
    rows = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, part int")
    table = VersionedTable(spark, scratch_path(spark, "vt"), "part", rows.schema)
    table.commit(rows, 1)
    for _ in range(2):
        table.commit(rows.where("part = 1 and id < 5"), 2, replaced=["1"])
    assert _rows(table.read(0, 9)) == _rows(rows.where("part = 0 or id < 5"))
    # a commit without its manifest does not count, and the next one replaces it
    rows.where("part = 0").write.partitionBy("part").parquet(os.path.join(table.root, "data", "v=3"))
    assert table.versions() == [1, 2]
    table.commit(rows.where("false"), 3, replaced=["0"])
    assert _rows(table.read(0, 9)) == _rows(rows.where("part = 1 and id < 5"))


def test_reads_need_bounds_and_prune(spark):
    rows = spark.createDataFrame([(i, dt.date(2024, 1 + i % 6, 1)) for i in range(30)], "id int, month date")
    table = VersionedTable(spark, scratch_path(spark, "vt"), "month", rows.schema)
    table.commit(rows, 1)
    with pytest.raises(ValueError):
        table.read(None, dt.date(2024, 2, 1))
    some = table.read(dt.date(2024, 2, 1), dt.date(2024, 3, 1))
    assert _rows(some) == _rows(rows.where("month between date'2024-02-01' and date'2024-03-01'"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_vacuum_keeps_what_the_last_versions_use(spark):
    rows = spark.createDataFrame([(i, i % 3) for i in range(9)], "id int, part int")
    table = VersionedTable(spark, scratch_path(spark, "vt"), "part", rows.schema)
    for v in range(1, 6):
        table.commit(rows.where(f"part = {v % 3}"), v, replaced=None if v == 1 else [str(v % 3)])
        table.vacuum()
    assert table.versions() == [4, 5]
    assert _rows(table.read(0, 9)) == _rows(table.read(0, 9, version=4)) == _rows(rows)
    assert not os.path.exists(os.path.join(table.root, "data", "v=1", "part=1"))  # replaced by version 4
    assert os.path.exists(os.path.join(table.root, "data", "v=2", "part=2"))  # version 4 still uses it


def test_stream_rewrites_touched_buckets_only(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = scratch_path(spark, "evsrc")
    ev.where("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(src)
    target = scratch_path(spark, "latest")
    table = lookback.latest_stream(spark, src, ["user_id", "event_type"], "ts", tie_break=["event_id"], target=target, buckets=16)
    before = _files(table)
    late = ev.where("event_id % 2 = 1").limit(2)
    late.coalesce(1).write.mode("append").parquet(src)
    again = lookback.latest_stream(spark, src, ["user_id", "event_type"], "ts", tie_break=["event_id"], target=target, buckets=16)
    touched = {f"key_bucket={r.b}" for r in late.select(F.pmod(F.xxhash64("user_id", "event_type"), F.lit(16)).alias("b")).collect()}
    after = _files(again)
    assert {f for f in before if os.path.basename(os.path.dirname(f)) not in touched} == {f for f in after if "v=0" in f}
    assert {os.path.basename(os.path.dirname(f)) for f in after - before} == touched
    both = ev.where("event_id % 2 = 0").unionByName(late)
    exp = latest_per_key(both, ["user_id", "event_type"], "ts", [F.col("event_id").desc()]).select("event_id", "user_id", "event_type")
    assert _rows(again.read(0, 15).select("event_id", "user_id", "event_type")) == _rows(exp)


def test_two_speed_refresh_equals_the_full_build(spark):
    runs = [dt.datetime(2000, 10, 20, 0), dt.datetime(2001, 3, 1, 4), dt.datetime(2001, 6, 15, 8), dt.datetime(2001, 11, 1, 4)]
    table = lookback.two_speed_headers(spark, SF_SMALL, runs[:3])
    kept = {p: f for p, f in table.manifest().items() if p < "2000-12-01"}
    third = int(runs[2].timestamp())
    assert kept and all(f"v={third}" not in f for f in kept.values())  # untouched months keep their files
    assert all(f"v={third}" in f for p, f in table.manifest().items() if p >= "2000-12-01")
    table = lookback.two_speed_headers(spark, SF_SMALL, runs[3:], root=table.root)
    full = lookback.order_headers(spark, SF_SMALL)
    assert _rows(table.read(dt.date(1990, 1, 1), dt.date(2010, 1, 1)).select(full.columns)) == _rows(full)
    plan = lookback.order_headers(spark, SF_SMALL, dt.date(2001, 5, 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan  # the partial run reads the look-back only
