"""Date windows (B1–B9) against the golden cases in FIXTURES.md §2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from promofund.functions import windows as Wn

D = dt.date

GOLDEN = [
    # run date, start, end, branch
    (D(2025, 7, 16), D(2025, 7, 7), D(2025, 7, 13)),    # default
    (D(2025, 7, 1), D(2025, 6, 30), D(2025, 7, 31)),    # 1st, not Monday
    (D(2025, 9, 1), D(2025, 8, 25), D(2025, 8, 31)),    # 1st and Monday -> default
    (D(2025, 9, 8), D(2025, 9, 1), D(2025, 9, 7)),      # README says first-Monday; SQL bound gives default
    (D(2025, 7, 7), D(2025, 7, 1), D(2025, 7, 6)),      # first Monday after the 1st
]


@pytest.mark.parametrize("run,start,end", GOLDEN)
def test_settlement_window_literal(run, start, end):
    assert Wn.settlement_window_literal(run) == (start, end)


def test_settlement_window_column_matches_literal(spark):
    runs = [(g[0],) for g in GOLDEN] + [(D(2024, 2, 29),), (D(2024, 3, 1),), (D(2024, 12, 2),)]
    df = spark.createDataFrame(runs, "run_date date")
    w = Wn.settlement_window(F.col("run_date"))
    got = {r.run_date: (r.s, r.e) for r in df.select("run_date", w["start_date"].alias("s"), w["end_date"].alias("e")).collect()}
    for (run,) in runs:
        assert got[run] == Wn.settlement_window_literal(run), run


def test_flags(spark):
    df = spark.createDataFrame([(D(2025, 9, 8),), (D(2025, 7, 7),), (D(2025, 7, 1),), (D(2025, 9, 1),)], "d date")
    rows = df.select("d", Wn.is_first_not_monday("d").alias("fnm"),
                     Wn.is_first_monday_after_first("d").alias("fma")).collect()
    flags = {r.d: (r.fnm, r.fma) for r in rows}
    assert flags[D(2025, 9, 8)] == (False, False)   # the README's claim does not hold
    assert flags[D(2025, 7, 7)] == (False, True)
    assert flags[D(2025, 7, 1)] == (True, False)
    assert flags[D(2025, 9, 1)] == (False, False)


def test_date_array_guard_n1(spark):
    df = spark.createDataFrame([(D(2025, 1, 3), D(2025, 1, 1)), (D(2025, 1, 1), D(2025, 1, 3))], "s date, e date")
    got = [r.a for r in df.select(Wn.date_array("s", "e").alias("a")).collect()]
    assert got[0] == []                      # Spark's sequence would count down
    assert got[1] == [D(2025, 1, 1), D(2025, 1, 2), D(2025, 1, 3)]


def test_rolling_horizon_month_end_clamp(spark):
    df = spark.createDataFrame([(D(1999, 11, 30),), (D(1999, 11, 29),)], "od date")
    got = [r.f for r in df.select(Wn.rolling_horizon("od", D(2001, 7, 31), D(2001, 7, 23), 20, 18).alias("f")).collect()]
    # 2001-07-31 minus 20 months clamps to 1999-11-30; the 18-month bound (2000-01-23) is the binding one
    assert got == [False, False]
    df2 = spark.createDataFrame([(D(1999, 11, 30),), (D(1999, 11, 29),)], "od date")
    got2 = [r.f for r in df2.select(Wn.rolling_horizon("od", D(2001, 7, 31), D(2001, 7, 23), 20, 30).alias("f")).collect()]
    assert got2 == [True, False]


def test_load_mode_bounds():
    m = Wn.LoadMode(mode="incremental", run_date=D(2025, 3, 10), look_back_days=7, pad=1)
    assert m.bounds() == (D(2025, 3, 2), D(2025, 3, 11))
    mg = Wn.LoadMode(mode="incremental", run_date=D(2025, 3, 3), look_back_days=7, month_grain=True)
    assert mg.bounds() == (D(2025, 2, 1), D(2025, 3, 1))
    assert Wn.LoadMode(mode="full").bounds() == (None, None)
    up = Wn.LoadMode(mode="incremental", run_date=D(2025, 3, 10), upper_only=True)      # B5c
    assert up.bounds() == (None, D(2025, 3, 10))
    b = Wn.LoadMode(mode="backfill", backfill_start=D(2024, 1, 1), backfill_end=D(2024, 6, 30), pad=1)
    assert b.bounds() == (D(2023, 12, 31), D(2024, 7, 1))
    with pytest.raises(ValueError):
        Wn.LoadMode(mode="backfill").bounds()


def test_billing_month(spark):
    df = spark.createDataFrame([("order_date", D(2025, 3, 15), D(2025, 5, 2)),
                                ("campaign_end_date", D(2025, 3, 15), D(2025, 5, 2)),
                                ("other", D(2025, 3, 15), D(2025, 5, 2))], "p string, od date, ce date")
    got = [r.m for r in df.select(Wn.billing_month("p", "od", "ce").alias("m")).collect()]
    assert got == [D(2025, 3, 1), D(2025, 5, 1), None]


def test_window_column_equals_driver_form_over_many_dates(spark):
    import random
    rnd = random.Random(5)
    days = [D(1995, 1, 1) + dt.timedelta(days=rnd.randint(0, 365 * 30)) for _ in range(600)]
    days += [D(2024, m, 1) for m in range(1, 13)] + [D(2024, 2, 29), D(2023, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "run_date date")
    w = Wn.settlement_window(F.col("run_date"))
    got = df.select("run_date", w["start_date"].alias("s"), w["end_date"].alias("e")).collect()
    for r in got:
        s, e = Wn.settlement_window_literal(r.run_date)
        assert (r.s, r.e) == (s, e), r.run_date
        assert s <= e and e < r.run_date or r.run_date.day == 1   # windows end before the run, except month starts
