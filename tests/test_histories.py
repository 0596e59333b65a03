"""The history sweep against plain interval joins, and F4's row pick."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from promofund.operators.dedup import latest_row, top1
from promofund.operators.intervals import History, hot_parts, interval_join, sweep_bucket, sweep_join
from promofund.plans import histories

D = dt.date


def _case(seed):
    rnd = random.Random(seed)
    base = D(1999, 11, 1)
    points = [(i, rnd.choice([0, 0, 0, 1, 2, 3]), base + dt.timedelta(days=rnd.randint(0, 900))) for i in range(400)]
    hist = {}
    for name in "abc":
        rows = []
        for k in range(4):
            day = base - dt.timedelta(days=rnd.randint(0, 400))
            while day < base + dt.timedelta(days=900):
                end = day + dt.timedelta(days=rnd.choice([0, 1, 40, 400]))
                rows.append((k, day, end, f"{name}{len(rows)}"))
                day = end + dt.timedelta(days=rnd.choice([0, 0, 30]))
                if rows[-1][1] == rows[-1][2]:
                    day += dt.timedelta(days=1)
            if k == 2:
                rows.append((k, D(2003, 1, 1), D(9999, 12, 31), name + "open"))
        hist[name] = rows
    return points, hist


@pytest.mark.parametrize("bucket", ["year", "month"])
@pytest.mark.parametrize("split", [None, 5])
def test_sweep_equals_interval_joins(spark, bucket, split):
    points, hist = _case(3)
    left = spark.createDataFrame(points, "pid int, k int, p date")
    frames = {n: spark.createDataFrame(r, f"k int, s date, e date, {n}_v string") for n, r in hist.items()}
    parts = None
    if split:
        parts = hot_parts(left.withColumn("__bucket", sweep_bucket("p", bucket)), ["k", "__bucket"], split)
        assert parts.count() > 0
    got = sweep_join(left, ["k"], "p", {n: History(f, "s", "e", (f"{n}_v",)) for n, f in frames.items()}, bucket=bucket, parts=parts)
    got = sorted((r.pid, r.k, r.p, *(r[n] and r[n][0] for n in "abc")) for r in got.collect())
    want = []
    for pid, k, p in points:
        held = [[v for kk, s, e, v in hist[n] if kk == k and s <= p < e] for n in "abc"]
        assert all(len(h) <= 1 for h in held)
        want.append((pid, k, p, *(h[0] if h else None for h in held)))
    assert got == sorted(want)


def test_sweep_shuffles_the_points_once(spark):
    points, hist = _case(4)
    left = spark.createDataFrame(points, "pid int, k int, p date")
    frames = {n: spark.createDataFrame(r, f"k int, s date, e date, {n}_v string") for n, r in hist.items()}
    swept = sweep_join(left, ["k"], "p", {n: History(f, "s", "e", (f"{n}_v",)) for n, f in frames.items()})
    joined = left
    for n, f in frames.items():
        joined = interval_join(joined, f, ["k"], "p", "s", "e", how="left", closed=False, bucket="year").drop("s", "e")

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(swept) == 1 < exchanges(joined)


def test_latest_row_equals_row_number(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 5), dt.datetime(2024, 1, 1 + rnd.randint(0, 3), rnd.randint(0, 23)), i, rnd.choice([None, "x", "y"])) for i in range(300)]
    rows += [(1, None, 1000, "null"), (9, None, 1001, None)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, id int, v string").withColumn("day", F.to_date("ts"))
    a = latest_row(df, ["k", "day"], ["ts", "id"], ["id", "ts", "v"])
    b = top1(df, ["k", "day"], [F.col("ts").desc_nulls_last()], [F.col("id").desc()]).select(a.columns)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan  # a row a key and task is shuffled


def test_histories_meet_every_branch(spark):
    out = histories.order_line_histories(spark, SF_SMALL)
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    seen = out.agg(*[F.count_if(c).alias(n) for n, c in {
        "weightable": F.col("is_weightable"), "plain": ~F.col("is_weightable"), "no_profit": F.col("total_ppp_lc").isNull(),
        "no_buffer": F.col("sales_buffer").isNull(), "no_piece": F.col("is_weightable") & F.col("average_weight_per_piece").isNull(),
        "discount": F.col("unit_discount_lc") > 0, "no_discount": F.col("unit_discount_lc") == 0}.items()]).first()
    assert all(seen), seen


def test_hot_lines_are_split(spark, monkeypatch):
    whole = sorted(map(str, histories.order_line_histories(spark, SF_SMALL).collect()))
    monkeypatch.setattr(histories, "ROWS_PER_PART", 2)
    assert sorted(map(str, histories.order_line_histories(spark, SF_SMALL).collect())) == whole


def test_sweep_without_buckets_equals_bucketed_and_repeats_no_version(spark):
    points, hist = _case(5)
    left = spark.createDataFrame([*points, (900, None, D(2000, 1, 1)), (901, 1, None)], "pid int, k int, p date")
    frames = {n: spark.createDataFrame(r, f"k int, s date, e date, {n}_v string") for n, r in hist.items()}
    held = {n: History(f, "s", "e", (f"{n}_v",)) for n, f in frames.items()}

    def rows(df):
        return sorted(str((r.pid, r.k, r.p, *(r[n] and r[n][0] for n in "abc"))) for r in df.collect())

    plain = sweep_join(left, ["k"], "p", held, bucket=None)
    assert rows(plain) == rows(sweep_join(left, ["k"], "p", held))
    assert "explode" not in plain._jdf.queryExecution().executedPlan().toString()
    parts = hot_parts(left, ["k"], 5)
    assert parts.count() > 0
    assert rows(sweep_join(left, ["k"], "p", held, bucket=None, parts=parts)) == rows(plain)


def test_line_histories_sweep_by_sku_alone(spark):
    plan = histories.order_line_histories(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "__bucket" not in plan and "sequence(" not in plan
