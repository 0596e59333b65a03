"""Sinks (A6–A8, A11), local dates (B9) and the two-speed refresh."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from promofund.functions.windows import local_date
from promofund.sources import sinks
from promofund.streaming.lookback import two_speed_mode


def test_write_clustered_sorts_files(spark):
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("k"), F.col("id").alias("v"))
    path = sinks.scratch_path(spark, "clustered")
    sinks.write_clustered(df, path, ["k"], num_partitions=4)
    back = spark.read.parquet(path)
    assert back.count() == 2000
    import glob
    files = sorted(glob.glob(path.replace("file:", "") + "/*.parquet"))
    ranges = []
    for f in files:
        ks = pq.read_table(f, columns=["k"]).column("k").to_pylist()
        assert ks == sorted(ks)                      # sorted within each file
        ranges.append((ks[0], ks[-1]))
    ranges.sort()
    for a, b in zip(ranges, ranges[1:]):
        assert a[1] < b[0]                           # disjoint key ranges across files


def test_replace_partitions_and_required_filter(spark):
    path = sinks.scratch_path(spark, "parts")
    d = dt.date
    full = spark.createDataFrame([(d(2025, 1, 1), 1), (d(2025, 1, 2), 2), (d(2025, 1, 3), 3)], "day date, v int")
    sinks.replace_partitions(full, path, ["day"])
    sinks.replace_partitions(spark.createDataFrame([(d(2025, 1, 2), 20)], "day date, v int"), path, ["day"])
    got = {(r.day, r.v) for r in sinks.read_partitioned(spark, path, "day", d(2025, 1, 1), d(2025, 1, 3)).collect()}
    assert got == {(d(2025, 1, 1), 1), (d(2025, 1, 2), 20), (d(2025, 1, 3), 3)}
    with pytest.raises(ValueError):
        sinks.read_partitioned(spark, path, "day", None, d(2025, 1, 3))


def test_stamp_is_explicit(spark):
    at = dt.datetime(2025, 5, 1, 12, 0)
    r = sinks.stamp(spark.range(1), at, "v2").first()
    assert r.ingested_at == at and r.settlement_version == "v2"


def test_local_date(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 3, 0),)], "ts timestamp")
    r = df.select(local_date("ts", "America/Lima").alias("lima"), local_date("ts", "Asia/Dubai").alias("dubai")).first()
    assert r.lima == dt.date(2024, 12, 31) and r.dubai == dt.date(2025, 1, 1)


def test_two_speed_mode():
    assert two_speed_mode(dt.datetime(2025, 3, 1, 0, 15)).mode == "full"
    m = two_speed_mode(dt.datetime(2025, 3, 1, 4, 0))
    assert m.mode == "incremental" and m.bounds() == (dt.date(2024, 9, 2), dt.date(2025, 3, 1))


def test_size_shuffles_scales_with_input(spark):
    from promofund.session import input_bytes, size_shuffles
    small = ["/root/testdata/sf0.001/lineitem.parquet"]
    big = ["/root/testdata/sf0.1/lineitem.parquet"]
    assert input_bytes(spark, big) > input_bytes(spark, small) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n_big = size_shuffles(spark, big, target_partition_bytes=1 << 20)
        n_small = size_shuffles(spark, small, target_partition_bytes=1 << 20)
        assert n_big > n_small >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
