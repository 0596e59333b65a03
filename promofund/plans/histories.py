"""Order lines with all their product histories in one sweep (L15: D6, F4, F6,
C24, C26, C27).

Seven histories of a product meet its order lines: VAT, price, cost, sales
buffer, and the weightable attributes sold-by-weight, sold-by-piece, minimum
weight and weight per piece, which arrive as (field, text value) updates of
which the last of a day counts (F4). All are keyed by SKU and half-open, so
``sweep_join`` finds the version of each that holds on the order day with one
shuffle of the lines, however many histories there are.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.operators.dedup import latest_row
from promofund.operators.intervals import History, hot_parts, sweep_join, validity_from_next
from promofund.operators.joins import checked_broadcast
from promofund.plans import curate, enrich
from promofund.sources.sinks import materialize
from promofund.sources.tables import scan

OPEN_END = _dt.date(9999, 12, 31)
# Rows of one SKU above which they are dealt over several tasks.
ROWS_PER_PART = 500_000
# Fixed calendar of the derived histories.
BUFFER_STARTS = (_dt.date(1995, 1, 1), _dt.date(1997, 1, 1), _dt.date(2000, 1, 1))
BUFFER_CLOSED = _dt.date(2001, 1, 1)
ATTRIBUTE_DAYS = (_dt.date(1996, 1, 1), _dt.date(1999, 6, 1))


def cost_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit cost per SKU and ship month: 60 % of the month's lowest unit price,
    until the next month with a shipment."""
    li = scan(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate", "l_extendedprice", "l_quantity"])
    per_month = (li.groupBy(F.col("l_partkey").alias("sku"), F.trunc("l_shipdate", "month").alias("valid_from"))
                 .agg((F.min(F.col("l_extendedprice") / F.col("l_quantity")) * 0.6).alias("unit_cost")))
    return validity_from_next(per_month, ["sku"], "valid_from", "valid_to", open_end=OPEN_END)


def buffer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sales-buffer versions per SKU; for every third SKU the last one has
    ended and nothing follows."""
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_size"])
    starts = [F.lit(BUFFER_STARTS[0]), F.date_add(F.lit(BUFFER_STARTS[1]), (F.col("p_partkey") % 200).cast("int")),
              F.date_add(F.lit(BUFFER_STARTS[2]), (F.col("p_partkey") % 100).cast("int"))]
    ends = [*starts[1:], F.when(F.col("p_partkey") % 3 == 0, F.lit(BUFFER_CLOSED)).otherwise(F.lit(OPEN_END))]
    versions = F.array(*[F.struct(a.alias("valid_from"), b.alias("valid_to"), ((F.col("p_size") + k) % 4).cast("bigint").alias("sales_buffer"))
                         for k, (a, b) in enumerate(zip(starts, ends, strict=True))])
    return part.select(F.col("p_partkey").alias("sku"), F.inline(versions))


def attribute_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw updates (sku, updated_field, updated_at, updated_value text): two on
    one day, the later one counts, and one on a later day. One scan of the products."""
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_size"]).where("p_size > 20")
    size, key = F.col("p_size"), F.col("p_partkey")
    day1 = F.date_add(F.lit(ATTRIBUTE_DAYS[0]), (key % 50).cast("int"))
    day2 = F.date_add(F.lit(ATTRIBUTE_DAYS[1]), (key % 30).cast("int"))
    even = F.when(size % 2 == 0, "true").otherwise("false")
    third = F.when(key % 3 == 0, "true").otherwise("false")
    piece = F.when(key % 7 == 0, "n/a").otherwise((size * 25).cast("string"))

    def update(field, day, hour, value):
        at = (F.unix_seconds(day.cast("timestamp")) + hour * 3600).cast("timestamp").cast("timestamp_ntz")
        return F.struct(F.lit(field).alias("updated_field"), at.alias("updated_at"), value.alias("updated_value"))

    updates = F.array(
        update("sold_by_weight", day1, 8, F.lit("false")), update("sold_by_weight", day1, 17, even), update("sold_by_weight", day2, 9, third),
        update("sold_by_piece", day1, 8, F.lit("true")), update("sold_by_piece", day1, 18, third), update("sold_by_piece", day2, 7, F.lit("false")),
        update("minimum_starting_weight", day1, 6, F.lit("1")), update("minimum_starting_weight", day1, 12, (size * 0.5).cast("string")),
        update("average_weight_per_piece", day1, 8, F.lit("1")), update("average_weight_per_piece", day1, 9, piece),
        update("average_weight_per_piece", day2, 9, F.lit("500")))
    return part.select(key.alias("sku"), F.inline(updates))


def attribute_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last update of each (sku, field, day) (F4), valid from that day to the next one's."""
    rows = attribute_updates(spark, sf_dir).withColumn("valid_from", F.to_date("updated_at"))
    kept = latest_row(rows, ["sku", "updated_field", "valid_from"], ["updated_at"], ["updated_value"])
    return materialize(validity_from_next(kept, ["sku", "updated_field"], "valid_from", "valid_to", open_end=OPEN_END))


def product_histories(spark: SparkSession, sf_dir: str) -> dict[str, History]:
    attributes = attribute_history(spark, sf_dir)

    def attribute(field, cast):
        return History(attributes.where(F.col("updated_field") == field).withColumn("value", F.col("updated_value").try_cast(cast)),
                       "valid_from", "valid_to", ("value",))

    return {
        "vat": History(enrich.vat_history(spark, sf_dir), "valid_from", "valid_to", ("vat_pct",)),
        "price": History(curate.price_history(spark, sf_dir), "valid_from", "valid_to", ("unit_price",)),
        "cost": History(cost_history(spark, sf_dir), "valid_from", "valid_to", ("unit_cost",)),
        "buffer": History(buffer_history(spark, sf_dir), "valid_from", "valid_to", ("sales_buffer",)),
        "by_weight": attribute("sold_by_weight", "boolean"),
        "by_piece": attribute("sold_by_piece", "boolean"),
        "min_weight": attribute("minimum_starting_weight", "double"),
        "piece_weight": attribute("average_weight_per_piece", "double"),
    }


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the order day, the other columns as they are: what
    follows from them is derived after the sweep, so that it is not shuffled."""
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                                          "l_tax", "l_returnflag", "l_linestatus"])
    o = scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), "l_linenumber", F.col("l_partkey").alias("sku"), F.col("o_orderdate").cast("date").alias("order_date"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def line_quantities(lines: DataFrame) -> DataFrame:
    """``dated_lines`` with the quantities of their life cycle and their money.
    A quantity that isn't known yet is NULL."""
    delivered = F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") % 5 == 0), F.lit(None)).otherwise(F.col("l_quantity"))
    returned = (F.when(F.col("l_returnflag") == "R", F.floor(F.col("l_quantity") / 2).cast("double"))
                .when(F.col("l_returnflag") == "A", F.lit(0.0)))
    rate = F.when(F.col("l_discount") > 0, F.col("l_discount")).otherwise(F.lit(0.0))
    return lines.withColumns({
        "quantity_ordered": F.col("l_quantity"), "quantity_delivered": delivered, "quantity_returned": returned,
        "unit_price_lc": F.col("l_extendedprice") / F.col("l_quantity"),
        "unit_price_paid_lc": (F.col("l_extendedprice") * (F.lit(1.0) - rate)) / F.col("l_quantity"),
        "total_amt_paid_lc": F.col("l_extendedprice") * (F.lit(1.0) - rate),
        "vat_percentage": F.col("l_tax") * 100})


def order_line_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with the versions in force and the money derived
    from them: listed price and discount from the price history (else the line's
    own price), cost of goods from the cost history (none: 0, but the unit cost
    falls back to the line's price), 1000 times for weightable products, profit
    (NULL while the delivered quantity is), weights of weightable products only."""
    hot = materialize(hot_parts(scan(spark, sf_dir, "lineitem", ["l_partkey"]).withColumnRenamed("l_partkey", "sku"), ["sku"], ROWS_PER_PART))
    parts = checked_broadcast(hot) if hot.take(1) else None
    # swept by SKU, without year buckets: open-ended versions would be repeated in every year
    j = line_quantities(sweep_join(dated_lines(spark, sf_dir), ["sku"], "order_date", product_histories(spark, sf_dir), bucket=None, parts=parts))
    price, cost = F.col("price.unit_price"), F.col("cost.unit_cost")
    sbw, sbp = F.col("by_weight.value"), F.col("by_piece.value")
    delivered, returned = F.col("quantity_delivered"), F.col("quantity_returned")
    listed = F.coalesce(price, F.col("unit_price_lc"), F.lit(0.0))
    kept = F.coalesce(delivered - F.coalesce(returned, F.lit(0.0)), F.lit(0.0))
    vat = F.coalesce(F.col("vat.vat_pct").cast("double"), F.col("vat_percentage"), F.lit(0.0))
    net = F.col("total_amt_paid_lc") / (F.lit(1.0) + vat / 100)
    cogs = F.coalesce(cost, F.lit(0.0)) * kept
    weightable = F.coalesce(sbw, F.lit(False)) | F.coalesce(sbp, F.lit(False))

    def weight(quantity):
        return F.when(weightable, quantity)

    return j.select(
        "order_id", "l_linenumber", "sku", "order_date", "quantity_ordered",
        F.coalesce(delivered, F.lit(0.0)).alias("quantity_delivered"), F.coalesce(returned, F.lit(0.0)).alias("quantity_returned"),
        kept.alias("quantity_sold"), vat.alias("product_vat_rate"), F.col("buffer.sales_buffer").alias("sales_buffer"),
        listed.alias("unit_price_listed_lc"),
        F.when(listed - F.col("unit_price_paid_lc") > 0, listed - F.col("unit_price_paid_lc")).otherwise(F.lit(0.0)).alias("unit_discount_lc"),
        F.coalesce(cost, F.col("unit_price_lc")).alias("unit_cost_lc"),
        F.when(sbw | sbp, cogs * 1000).otherwise(cogs).alias("amt_cogs_lc"),
        net.alias("total_amt_paid_net_lc"), (net - F.coalesce(cost, F.lit(0.0)) * delivered).alias("total_ppp_lc"),
        weightable.alias("is_weightable"), weight(F.col("quantity_ordered")).alias("ordered_weight"), weight(delivered).alias("delivered_weight"),
        weight(kept).alias("sold_weight"), weight(returned).alias("returned_weight"), weight(F.lit("KG")).alias("weight_unit"),
        F.col("min_weight.value").alias("minimum_starting_weight"), F.col("piece_weight.value").alias("average_weight_per_piece"))


def latest_event_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 on events: the whole latest row per (user, day of the event)."""
    ev = scan(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    return latest_row(ev, ["user_id", "event_date"], ["ts", "event_id"], ["event_id", "ts", "event_type", "value", "props"])
