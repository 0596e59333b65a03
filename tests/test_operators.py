"""Operators: dedupe, interval joins, fallback join, nesting, quality."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from promofund.operators import quality as Q
from promofund.operators.dedup import latest_per_key, priority_dedupe, top1, union_sources
from promofund.operators.intervals import (fallback_join, interval_join, next_value_split, validity_from_lag_desc,
                                          validity_from_next)
from promofund.operators.nested import distinct_join, nest, unnest

D = dt.date


def test_top1_tie_break_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (2, None, "x"), (2, 1, "y")],
                               "k int, v int, tag string")
    got = {r.k: r.tag for r in top1(df, ["k"], [F.col("v").desc_nulls_last()], [F.col("tag").asc()]).collect()}
    assert got == {1: "a", 2: "y"}


def test_latest_and_priority(spark):
    old = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), 10.0)], "id int, ts timestamp, v double")
    new = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))], "id int, ts timestamp")
    u = union_sources([(old, "old", 2), (new, "new", 1)])
    assert u.where("src = 'new'").select("v").first().v is None          # typed NULL padding (H3)
    latest = {r.id: r.src for r in latest_per_key(u, ["id"], "ts").collect()}
    assert latest == {1: "old", 2: "new"}
    prio = {r.id: r.src for r in priority_dedupe(u, ["id"]).collect()}
    assert prio == {1: "new", 2: "new"}


def _rand_case(seed):
    rnd = random.Random(seed)
    base = D(2000, 1, 1)
    points = [(i, rnd.randint(0, 3), base + dt.timedelta(days=rnd.randint(0, 700))) for i in range(300)]
    ivs = []
    for j in range(60):
        s = base + dt.timedelta(days=rnd.randint(-30, 700))
        ivs.append((j, rnd.randint(0, 3), s, s + dt.timedelta(days=rnd.randint(-5, 200))))
    return points, ivs


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("cap", [None, D(2001, 1, 1)])
@pytest.mark.parametrize("grain", ["month", "year"])
def test_bucketed_interval_join_equals_plain(spark, closed, how, cap, grain):
    points, ivs = _rand_case(7)
    left = spark.createDataFrame(points, "pid int, k int, p date")
    right = spark.createDataFrame(ivs, "iid int, k int, s date, e date")
    a = interval_join(left, right, ["k"], "p", "s", "e", how=how, closed=closed, bucket=grain, bucket_until=cap)
    b = interval_join(left, right, ["k"], "p", "s", "e", how=how, closed=closed, bucket=None)
    ra = sorted(tuple(r) for r in a.collect())
    rb = sorted(tuple(r) for r in b.collect())
    assert ra == rb and len(ra) > 0
    # brute force
    exp = []
    for pid, k, p in points:
        hit = [(j, s, e) for j, kk, s, e in ivs if kk == k and s <= p and (p <= e if closed else p < e)]
        if hit:
            exp += [(pid, k, p, j, s, e) for j, s, e in hit]
        elif how == "left":
            exp.append((pid, k, p, None, None, None))
    assert sorted(map(str, ra)) == sorted(map(str, exp))


def test_validity_quirk_n7(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)
    df = spark.createDataFrame([("A", t2), ("B", t1), ("C", None)], "v string, m timestamp").withColumn("w", F.lit(1))
    df = validity_from_lag_desc(df, ["w"], "m", "valid_from", default=dt.datetime(1970, 1, 1))
    df = df.withColumn("valid_to", F.coalesce("m", F.lit(dt.datetime(2030, 1, 1))))
    got = {r.v: (r.valid_from, r.valid_to) for r in df.collect()}
    assert got["A"] == (dt.datetime(1970, 1, 1), t2)
    assert got["B"] == (t2, t1)                    # empty interval: the reference's quirk
    assert got["C"] == (t1, dt.datetime(2030, 1, 1))
    fixed = validity_from_lag_desc(df.drop("valid_from"), ["w"], "m", "valid_from", corrected=True)
    assert {r.v: r.valid_from for r in fixed.collect()}["A"] == t1


def test_validity_from_next(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1)), (1, D(2024, 2, 1)), (2, D(2024, 1, 5))], "k int, f date")
    got = sorted(tuple(r) for r in validity_from_next(df, ["k"], "f", open_end=D(9999, 12, 31)).collect())
    assert got == [(1, D(2024, 1, 1), D(2024, 2, 1)), (1, D(2024, 2, 1), D(9999, 12, 31)),
                   (2, D(2024, 1, 5), D(9999, 12, 31))]


def test_fallback_join(spark):
    left = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 10)], "p int, s int")
    first = spark.createDataFrame([(1, 10, 5.0)], "p int, s int, cost double")
    second = spark.createDataFrame([(1, 7.0), (2, 8.0)], "p int, cost double")
    got = sorted(tuple(r) for r in fallback_join(left, first, ["p", "s"], second, ["p"], ["cost"]).collect())
    assert got == [(1, 10, 5.0, "first"), (1, 11, 7.0, "second"), (2, 10, 8.0, "second"), (3, 10, None, None)]


def test_nest_unnest_roundtrip(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "o int, n int, x string")
    nested = nest(df, ["o"], "items", ["n", "x"])
    got = {r.o: [tuple(i) for i in r.items] for r in nested.collect()}
    assert got == {1: [(1, "a"), (2, "b")], 2: [(1, "c")]}
    flat = unnest(nested, "items", alias="it", with_position=True)
    assert sorted(tuple(r) for r in flat.collect()) == [(1, 0, 1, "a"), (1, 1, 2, "b"), (2, 0, 1, "c")]
    s = nested.select(distinct_join(F.array(F.lit("b"), F.lit("a"), F.lit("b")), None).alias("j")).first().j
    assert s == "a,b"


def test_nest_has_one_grain_at_every_size(spark):
    sizes = {0: 1, 1: 50, 2: 12_000}
    df = spark.createDataFrame([(k, i) for k, n in sizes.items() for i in range(n)], "k int, v int").repartition(5)
    out = {r.k: [x.v for x in r["items"]] for r in nest(df, ["k"], "items", ["v"]).collect()}
    assert out == {k: list(range(n)) for k, n in sizes.items()}


def test_conditional_nest_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "o int, v string")
    got = {r.o: r.items for r in nest(df, ["o"], "items", ["v"], present=F.col("v").isNotNull()).collect()}
    assert got[1] == [] and len(got[2]) == 1


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "k int, v string")
    rows = {(r.check_name, r.target): (r.failing_rows, r.status) for r in Q.suite(
        Q.no_nulls(df, "t", ["k", "v", "absent"]),
        Q.no_duplicates(df, "t", ["k"]),
        Q.statement_true(df, "t", "uniq", "COUNT(DISTINCT k) = COUNT(*)")).collect()}
    assert rows[("no_nulls", "k")] == (0, "pass")
    assert rows[("no_nulls", "v")] == (1, "fail")
    assert rows[("no_nulls", "absent")] == (None, "column_missing")     # N16
    assert rows[("no_duplicates", "k")] == (1, "fail")
    assert rows[("statement_true", "uniq")] == (1, "fail")


def test_hot_key_is_split_by_aqe(spark):
    """One SKU holds a third of all lines: the interval join + top-1 (T4's
    shape) stays correct and AQE splits the hot partition of the join."""
    confs = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}  # force the shuffle path
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 120_000
        lines = spark.range(n).select(
            F.col("id").alias("line_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).alias("sku"),
            F.date_add(F.lit(D(2000, 1, 1)), (F.col("id") % 30).cast("int")).alias("d"))
        rules = spark.range(2000).select(F.col("id").alias("sku"), F.lit(D(1999, 12, 1)).alias("s"),
                                         F.lit(D(2000, 3, 1)).alias("e"), F.col("id").alias("rid"))
        plain = interval_join(lines, rules, ["sku"], "d", "s", "e", how="left", bucket=None)
        assert plain.count() == n
        plain.collect()
        assert "skew=true" in plain._jdf.queryExecution().executedPlan().toString()
        j = interval_join(lines, rules, ["sku"], "d", "s", "e", how="left", bucket="year", keep_bucket=True)
        best = top1(j, ["sku", "__bucket", "line_id"], [F.col("rid").desc_nulls_last()])
        got = best.select("line_id", "rid").collect()
        assert len(got) == n and all(r.rid == (7 if r.line_id % 3 == 0 else r.line_id % 2000) for r in got)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_split_lead_equals_window(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.randint(0, 2), base + dt.timedelta(minutes=rnd.randint(0, 60 * 72))) for i in range(400)]
    rows += [(1000, 0, rows[0][2]), (1001, 0, rows[0][2])]          # equal timestamps, tie-broken by id
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp")
    a = next_value_split(df, ["k"], "ts", "nxt", tie_break=["id"], grain="hour")
    b = validity_from_next(df, ["k"], "ts", "nxt", tie_break=["id"])
    assert sorted(map(tuple, a.select("id", "nxt").collect())) == sorted(map(tuple, b.select("id", "nxt").collect()))
