"""Date-window jobs (B1–B8) evaluated for every run date at once.

Run dates are the distinct order dates, so each job's work grows with the
order table. Per-day pre-aggregation keeps the date-range joins small: orders
are first counted per day (a partial aggregate before the shuffle), then the
windows — exploded into their days, at most a month each — meet those counts
on an equi key.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions import windows as Wn
from promofund.sources import domain
from promofund.sources.sinks import materialize
from promofund.sources.tables import scan


@domain.per_session
def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order dates (one row per calendar day: small, materialised)."""
    return materialize(scan(spark, sf_dir, "orders", ["o_orderdate"])
                       .select(F.col("o_orderdate").cast("date").alias("run_date")).distinct())


def settlement_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1–B3 for each run date."""
    d = F.col("run_date")
    w = Wn.settlement_window(d)
    return run_dates(spark, sf_dir).select(
        "run_date",
        Wn.week_monday(d).alias("week_monday"),
        Wn.month_first(d).alias("month_first"),
        Wn.is_first_not_monday(d).alias("is_first_of_month_not_monday"),
        Wn.is_first_monday_after_first(d).alias("is_first_monday_after_first"),
        w["start_date"].alias("start_date"), w["end_date"].alias("end_date"))


def window_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day partitions each run refreshes (its settlement window)."""
    w = settlement_windows(spark, sf_dir)
    return w.select("run_date", F.explode(Wn.date_array(F.col("start_date"), F.col("end_date")))
                    .alias("partition_date")).distinct()


def load_mode_windows(spark: SparkSession, sf_dir: str, look_back_days: int = 7, pad: int = 1) -> DataFrame:
    """Per run date, the padded incremental window, its month
    grain, and how many orders that window reprocesses."""
    d = F.col("run_date")
    win = Wn.load_window(d, look_back_days, pad)
    mon = Wn.load_window(d, look_back_days, pad, month_grain=True)
    runs = run_dates(spark, sf_dir).select(
        "run_date", win["lo"].alias("window_lo"), win["hi"].alias("window_hi"),
        mon["lo"].alias("month_lo"), mon["hi"].alias("month_hi"))
    per_day = (scan(spark, sf_dir, "orders", ["o_orderdate"])
               .groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")))
    days = runs.select("run_date", F.explode(Wn.date_array(F.col("window_lo"), F.col("window_hi"))).alias("day"))
    counts = days.join(per_day, "day").groupBy("run_date").agg(F.sum("n").alias("n_orders"))
    return runs.join(counts, "run_date", "left").select(
        "run_date", "window_lo", "window_hi", "month_lo", "month_hi",
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("n_orders"))


def rolling_horizon_flags(spark: SparkSession, sf_dir: str,
                          run_date: _dt.date = _dt.date(2001, 7, 31)) -> DataFrame:
    """Which orders fall in the v1 rolling horizon of one run (window
    bounds evaluated on the driver -> literals -> pushed-down predicate)."""
    start, _ = Wn.settlement_window_literal(run_date)
    od = F.col("o_orderdate").cast("date")
    return scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"]).select(
        F.col("o_orderkey").alias("order_id"), od.alias("order_date"),
        Wn.rolling_horizon(od, F.lit(run_date), F.lit(start)).alias("in_horizon"))


def billing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the billing month its entity's config asks for; the
    campaign end stands in as the order's last ship date."""
    orders = scan(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    last_ship = (scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
                 .groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("campaign_end_date")))
    ent = domain.entities(spark, sf_dir)
    cfg = domain.config(spark).select("global_entity_id", "param_billing_period")
    o = (orders.join(ent, orders.o_custkey == ent.c_custkey)
         .join(F.broadcast(cfg), "global_entity_id")
         .join(last_ship, orders.o_orderkey == last_ship.l_orderkey, "left"))
    return o.select(
        F.col("o_orderkey").alias("order_id"), "global_entity_id", "param_billing_period",
        Wn.billing_month("param_billing_period", F.col("o_orderdate").cast("date"),
                         F.col("campaign_end_date")).alias("billing_month"))
