"""Order-line enrichment by histories (L15 shape: D5, D6, D11, F6, F7, C27).

Three histories meet the order lines:

* VAT per product, stored with ``valid_from`` only: ``valid_to`` is the next
  version's start (F6), joined half-open ``[from, to)`` on the order day (D6);
* the warehouse a supplier ships from, stored as migrations: ``valid_from``
  comes from ``LAG(migrated_at) OVER (ORDER BY migrated_at DESC)`` exactly as
  the reference computes it (N7: with two migrations the middle interval is
  empty and the current one overlaps the oldest), joined closed on the order
  instant (D5) — lines in the overlap match twice, as in the reference;
* a daily FX rate joined on a computed key, the ship day (D11); a missing
  rate leaves the EUR value NULL.

Scale: every history has a bounded number of versions per key (2 per
product, 3 per supplier), so the joins are plain sort-merge joins on the key
with the range as a residual; a hot product or supplier is split by AQE's
skew handling on the line side while its few versions are replicated.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.operators.intervals import interval_join, validity_from_lag_desc, validity_from_next
from promofund.plans import calendar
from promofund.sources.tables import scan

MONEY = "decimal(18,2)"
# Fixed calendar of the derived histories.
HISTORY_START = _dt.date(1995, 1, 1)
VAT_CHANGE_FROM = _dt.date(1998, 1, 1)
MIGRATION_1_FROM = _dt.date(1997, 1, 1)
MIGRATION_2_FROM = _dt.date(1996, 1, 1)
WAREHOUSE_OPEN_START = _dt.datetime(1970, 1, 1)
WAREHOUSE_OPEN_END = _dt.datetime(2030, 1, 1)
OPEN_END = _dt.date(9999, 12, 31)


def vat_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two VAT versions per product, ``valid_from`` only; ``valid_to`` by F6."""
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_size"])
    base = (F.col("p_size") % 3) * 5
    v1 = part.select(F.col("p_partkey").alias("sku"), F.lit(HISTORY_START).alias("valid_from"), base.alias("vat_pct"))
    v2 = part.select(F.col("p_partkey").alias("sku"),
                     F.date_add(F.lit(VAT_CHANGE_FROM), (F.col("p_partkey") % 365).cast("int")).alias("valid_from"),
                     (base + 1).alias("vat_pct"))
    return validity_from_next(v1.unionByName(v2), ["sku"], "valid_from", "valid_to", open_end=OPEN_END)


def warehouse_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier -> warehouse migrations (current row has no migration time),
    with the reference's LAG-over-DESC validity (F7, N7)."""
    sup = scan(spark, sf_dir, "supplier", ["s_suppkey"])
    s = F.col("s_suppkey")

    def wh(shift):
        return F.concat(F.lit("W"), ((s + shift) % 5).cast("string"))

    def at(start):
        return F.date_add(F.lit(start), (s % 300).cast("int")).cast("timestamp_ntz")
    cur = sup.select(s.alias("supplier_id"), wh(0).alias("warehouse_id"), F.lit(None).cast("timestamp_ntz").alias("migrated_at"))
    m1 = sup.select(s.alias("supplier_id"), wh(1).alias("warehouse_id"), at(MIGRATION_1_FROM).alias("migrated_at"))
    m2 = sup.select(s.alias("supplier_id"), wh(2).alias("warehouse_id"), at(MIGRATION_2_FROM).alias("migrated_at"))
    h = validity_from_lag_desc(cur.unionByName(m1).unionByName(m2), ["supplier_id"], "migrated_at", "valid_from",
                               default=WAREHOUSE_OPEN_START)
    return h.withColumn("valid_to", F.coalesce(F.col("migrated_at"), F.lit(WAREHOUSE_OPEN_END)))


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per calendar day that has orders (exact binary fractions)."""
    d = calendar.run_dates(spark, sf_dir)
    return d.select(F.col("run_date").alias("fx_date"),
                    (F.lit(1.0) + (F.dayofyear("run_date") % 8).cast("double") * 0.125).alias("fx_rate"))


def order_line_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_extendedprice", "l_discount", "l_shipdate"])
    orders = scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    rate = F.when(F.col("l_discount") > 0, F.col("l_discount")).otherwise(F.lit(0.0))
    total = F.col("l_extendedprice").cast(MONEY)
    paid = (total - F.round(total * rate.cast("decimal(4,2)"), 2)).cast(MONEY)
    lines = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("supplier_id"),
        F.col("o_orderdate").alias("order_ts"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.to_date("l_shipdate").alias("ship_date"), paid.alias("paid_lc"))
    vat = vat_history(spark, sf_dir).select("sku", F.col("valid_from").alias("vat_from"),
                                            F.col("valid_to").alias("vat_to"), "vat_pct")
    j = interval_join(lines, vat, ["sku"], "order_date", "vat_from", "vat_to", how="left", closed=False, bucket=None)
    wh = warehouse_history(spark, sf_dir).select("supplier_id", F.col("warehouse_id").alias("wh_warehouse_id"),
                                                 F.col("valid_from").alias("wh_valid_from"),
                                                 F.col("valid_to").alias("wh_valid_to"))
    j = interval_join(j, wh, ["supplier_id"], "order_ts", "wh_valid_from", "wh_valid_to", how="left", closed=True,
                      bucket=None)
    fx = fx_daily(spark, sf_dir)
    j = j.join(fx, j.ship_date == fx.fx_date, "left")          # D11: key computed from a timestamp
    net = F.col("paid_lc").cast("double") / (F.lit(1.0) + F.col("vat_pct").cast("double") / 100.0)
    return j.select(
        "l_orderkey", "l_linenumber", "sku", "supplier_id", "order_date", "ship_date", "vat_pct",
        "wh_warehouse_id", "wh_valid_from", "wh_valid_to", "paid_lc", net.alias("net_sales_lc"), "fx_rate",
        (F.col("paid_lc").cast("double") / F.col("fx_rate")).alias("total_amt_paid_eur"))
