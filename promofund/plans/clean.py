"""Clean layer (L1–L8, L13, L30 shapes) over two generations of a raw source.

The input's ``events`` table plays the raw promo-tool feed: event types
'view' and 'click' are the old generation ("cart"), the others the new one
("app"); the business key is (user_id, props) and ``ts`` orders versions.
The new generation carries no ``value`` column (schema padding, H3).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions.scalars import (array_to_string_strict, json_scalar, safe_double, size_or_null, split_part_safe,
                                         strict_least, text_to_bool)
from promofund.operators.dedup import latest_per_key, merge_latest, newest_beside, priority_dedupe, top1, union_sources
from promofund.operators.intervals import next_value_split
from promofund.sources.tables import scan

# Fixed source names and priorities (lower wins), as the clean jobs tag them.
OLD_SOURCE, NEW_SOURCE = "cart", "app"
OLD_TYPES = ("view", "click")
OLD_PRIORITY, NEW_PRIORITY = 2, 1


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])


def raw_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = events(spark, sf_dir)
    old = ev.where(F.col("event_type").isin(*OLD_TYPES))
    new = ev.where(~F.col("event_type").isin(*OLD_TYPES)).drop("value")
    return old, new


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """newest event per (user_id, event_type)."""
    return latest_per_key(events(spark, sf_dir), ["user_id", "event_type"], "ts",
                          tie_break=[F.col("event_id").desc()])


def priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2/H1: union both generations, keep the highest-priority source per
    key, newest within it."""
    old, new = raw_sources(spark, sf_dir)
    u = union_sources([(old, OLD_SOURCE, OLD_PRIORITY), (new, NEW_SOURCE, NEW_PRIORITY)])
    return priority_dedupe(u, ["user_id", "props"], "src_priority",
                           tie_break=[F.col("ts").desc_nulls_last(), F.col("event_id").desc()])


def two_source_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 shape (H1, H3, F1, D15, C26): newest version per key across both
    generations, payload recovered from the winning source, missing value
    defaulted to 0."""
    old, new = raw_sources(spark, sf_dir)
    merged = merge_latest([(old, OLD_SOURCE, OLD_PRIORITY), (new, NEW_SOURCE, NEW_PRIORITY)],
                          keys=["user_id", "props"], ts="ts", payload_keys=["user_id", "props"],
                          tie_break=[F.col("event_id").desc()])
    return merged.select("user_id", "props", "ts", "src", "event_id", "event_type",
                         F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar JSON extraction with a safe numeric cast."""
    ev = events(spark, sf_dir)
    k = json_scalar("props", "$.k")
    return ev.select("event_id", k.alias("k_text"), safe_double(k).alias("k_num"),
                     json_scalar("props", "$").alias("root_scalar"))


def validity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """versions per (user_id, event_type): valid_to = next version's
    start; and the reference's ``LAG(ts) OVER (ORDER BY ts DESC)`` valid_from
    (N7), which is the same next-later timestamp (LAG over a descending order
    is LEAD over the ascending one with mirrored tie-breaks). Both come from
    the hot-key-safe split LEAD."""
    ev = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    ev = next_value_split(ev, ["user_id", "event_type"], "ts", "valid_to", tie_break=["event_id"])
    return ev.select("event_id", F.col("ts").alias("valid_from"), "valid_to",
                     F.col("valid_to").alias("quirk_valid_from"))


def latest_line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per (order, line number) by ship date DESC NULLS LAST,
    price DESC NULLS LAST, then every other column as the total-order
    tie-break (the line table has no shorter unique key)."""
    li = scan(spark, sf_dir, "lineitem")
    return top1(li, ["l_orderkey", "l_linenumber"],
                [F.col("l_shipdate").desc_nulls_last(), F.col("l_extendedprice").desc_nulls_last()],
                [F.col(c).asc() for c in ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                                          "l_returnflag", "l_linestatus")])


__all__ = ["events", "raw_sources", "latest_events", "priority_merge", "two_source_merge",
           "json_fields", "validity_history", "latest_line_versions", "union_sources"]


# ------------------------------------------------------------------ vendors, triggers, order campaigns, old benefits
# Fixed values of the vendor rules (C7/C15/C11): a LIKE prefix where '_' is a
# wildcard, and the entities whose brand flag counts.
VENDOR_FAMILY_PATTERN = "NATION_1%"
FLAGGED_NATIONS = ("NATION_2", "NATION_4")


def clean_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 (C7, C15, C11, C8): vendor codes split into two columns by an
    entity-family LIKE pattern; a three-valued OR flag; ``IS FALSE`` test."""
    from promofund.sources.tables import scan as _scan
    sup = _scan(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    nation = _scan(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    v = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey)   # nation: fixed 25 rows
    fam = F.col("n_name").like(VENDOR_FAMILY_PATTERN)
    nullable_flag = F.when(F.col("s_suppkey") % 3 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_acctbal") > 0)
    key_vendor = (F.col("s_acctbal") > 9000) | (F.col("n_name").isin(*FLAGGED_NATIONS) & nullable_flag)
    return v.select(
        F.col("s_suppkey").alias("vendor_id"), "n_name",
        F.when(fam, F.col("s_name")).alias("platform_code_a"),
        F.when(~fam, F.col("s_name")).alias("platform_code_b"),
        key_vendor.alias("is_key_vendor"),
        key_vendor.eqNullSafe(False).alias("is_key_vendor_false"),
        F.nullif(F.col("s_name"), F.lit("")).isNotNull().alias("has_name"))


def raw_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old-generation trigger rows: one per (family-1 campaign, product),
    plus a later re-statement (vendor changed) for products above size 25;
    the SKU column is missing on some rows (product id still present)."""
    from promofund.sources import domain
    rows = domain.raw_campaign_rows(spark, sf_dir).where(F.col("family") == 1)
    base = rows.select(
        "campaign_id", F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None).cast("bigint")).otherwise(F.col("p_partkey")).alias("sku"),
        (F.col("p_partkey") % 10).alias("vendor_id"),
        F.date_add("start_date", F.col("p_size")).cast("timestamp_ntz").alias("modified_at"),
        "p_size")
    later = (base.where(F.col("p_size") > 25)
             .withColumn("vendor_id", (F.col("vendor_id") + 1) % 10)
             .withColumn("modified_at", F.col("modified_at") + F.expr("INTERVAL 1 DAY")))
    return base.unionByName(later).drop("p_size")


def campaign_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 (F1, C26, E14): latest version per (campaign, product), key repaired
    with COALESCE(sku, product_id), then DISTINCT."""
    latest = latest_per_key(raw_triggers(spark, sf_dir), ["campaign_id", "product_id"], "modified_at",
                            tie_break=[F.col("vendor_id").asc()])
    return latest.select("campaign_id", F.coalesce("sku", "product_id").alias("sku"), "vendor_id").distinct()


def campaign_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors a campaign runs with (from the latest triggers), with
    their number of trigger SKUs."""
    t = campaign_triggers(spark, sf_dir)
    return t.groupBy("campaign_id", "vendor_id").agg(F.count(F.lit(1)).alias("n_skus"))


def order_campaign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 combo rows (C30): a line whose product is a combo (size above 45)
    adds one row per component (parent = the combo) next to its own row
    (parent NULL): order 123 with combo A of A1, A2 -> (A, A1), (A, A2), (NULL, A)."""
    from promofund.sources.tables import scan as _scan
    li = _scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey"])
    part = _scan(spark, sf_dir, "part", ["p_partkey", "p_size"])
    j = li.join(part, li.l_partkey == part.p_partkey)
    comps = F.when(F.col("p_size") > 45, F.array(F.col("l_partkey") + 1, F.col("l_partkey") + 2)).otherwise(
        F.array().cast("array<bigint>"))
    own = j.select(F.col("l_orderkey").alias("order_id"), F.lit(None).cast("bigint").alias("parent_product_id"),
                   F.col("l_partkey").alias("product_id"))
    combo = j.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("parent_product_id"),
                     F.explode(comps).alias("product_id"))
    out = own.unionByName(combo)
    return out.withColumn("is_combo_product", F.col("parent_product_id").isNotNull())


def old_benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old benefit rows whose missing ``created_at`` falls back to
    ``updated_at``; newest per (campaign, sku)."""
    from promofund.sources import domain
    rows = domain.raw_campaign_rows(spark, sf_dir)
    raw = rows.select(
        "campaign_id", F.col("p_partkey").alias("sku"),
        F.when(F.col("p_size") % 6 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_sub("start_date", 3).cast("timestamp_ntz")).alias("created_at"),
        F.date_add("start_date", F.col("p_size")).cast("timestamp_ntz").alias("updated_at"),
        (F.col("p_retailprice") * 0.1).alias("discount"))
    raw = raw.withColumn("created_at", F.coalesce("created_at", "updated_at"))
    return latest_per_key(raw, ["campaign_id", "sku"], "updated_at", tie_break=[F.col("created_at").desc()])


def _promo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two generations of the promo tool know of an order's products:
    one row per order line, the product missing on every 11th. Lines meet their
    order last, so they are dealt by order, as the merges need them."""
    from promofund.sources import domain
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"])
    o = scan(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    headers = (o.join(domain.entities(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
               .select("o_orderkey", "o_orderdate", "country_code", "global_entity_id"))
    known = li.where((F.col("l_linenumber") % 2 == 1) | (F.col("l_linenumber") % 3 == 0))  # lines of either generation
    j = known.join(part, li.l_partkey == part.p_partkey).join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select(
        "country_code", "global_entity_id", F.col("l_orderkey").alias("order_id"),
        F.concat(F.lit("C1-"), F.substring("p_brand", 7, 8), F.lit("-"), (F.col("p_size") % 4).cast("string")).alias("campaign_id"),
        F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("product_id"),
        F.when(F.col("p_size") > 45, F.col("l_partkey") - 1).alias("parent_product_id"),
        "l_linenumber", "p_size", F.col("l_quantity").alias("product_qty"), F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total"),
        F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.greatest(F.col("l_discount"), F.lit(0.0)).cast("decimal(4,2)"), 2)
        .cast("decimal(18,2)").alias("discount_lc"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered_at"))


# The generations in the order in which their values count.
PROMO_SOURCES = ("cart", "app")


def promo_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions of both generations, ``__n`` numbering PROMO_SOURCES: the cart
    generation (odd lines; products of every fifth size are sent again a day later
    with one cent less) and the app generation (every third line, an hour after
    its line number modulo 4), which knows fewer columns: they are NULL.

    One pass: a line is joined once, whichever generations send it."""
    line, size = F.col("l_linenumber"), F.col("p_size")

    def version(n, again):
        return F.struct(F.lit(n).alias("__n"), F.lit(again).alias("again"))

    odd, third = line % 2 == 1, line % 3 == 0
    sent = F.array(F.when(odd, version(0, 0)), F.when(odd & (size % 5 == 0), version(0, 1)), F.when(third, version(1, 0)))
    rows = _promo_rows(spark, sf_dir).select("*", F.inline(F.filter(sent, lambda v: v.isNotNull())))
    cart = F.col("__n") == 0
    hours = F.when(cart, line + 24 * F.col("again")).otherwise(line % 4)
    return rows.withColumns({
        "created_at": (F.unix_seconds(F.col("ordered_at").cast("timestamp")) + hours * 3600).cast("timestamp").cast("timestamp_ntz"),
        "discount_lc": (F.col("discount_lc") - F.col("again") * F.lit(Decimal("0.01"))).cast("decimal(18,2)"),
        "is_combo_product": F.when(cart, F.col("parent_product_id").isNotNull()),
        "supplier_funded_amount": F.when(cart & (size % 2 == 0), F.round(F.col("discount_lc") * F.lit(Decimal("0.5")), 2)).cast("decimal(18,2)"),
        "benefit_qty": F.when(cart & (F.col("flag") != "N"), (size % 3).cast("bigint")),
        "external_funder": F.when(cart & (size % 10 == 0), "brand"),
        "parent_product_id": F.when(cart, F.col("parent_product_id"))})


def _merged_promo(spark: SparkSession, sf_dir: str, keys: list[str], payload: list[str]) -> DataFrame:
    names = F.array(*[F.lit(name) for name in PROMO_SOURCES])
    rows = promo_versions(spark, sf_dir).select(*keys, "created_at", "__n", F.struct(*payload, names[F.col("__n")].alias("src")).alias("__row"))
    return newest_beside(rows, keys, "created_at", [*payload, "src"], len(PROMO_SOURCES))


def order_campaign_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3: the newest version per (country, order, campaign, product) of both
    generations, payload recovered; a missing product loses it (N17)."""
    payload = ["global_entity_id", "parent_product_id", "is_combo_product", "discount_lc", "supplier_funded_amount", "benefit_qty", "external_funder"]
    return _merged_promo(spark, sf_dir, ["country_code", "order_id", "campaign_id", "product_id"], payload)


def order_item_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the newest version per (country, order, product) of both generations."""
    payload = ["global_entity_id", "parent_product_id", "is_combo_product", "product_qty", "total", "discount_lc"]
    return _merged_promo(spark, sf_dir, ["country_code", "order_id", "product_id"], payload)


def product_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I7, I9, I10, I14, I15, I19, I25 on product texts: offsets that give NULL
    and one that must exist, arrays that may be NULL, texts that are a boolean or
    not, LEAST with NULLs, times with and without a zone."""
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_size"])
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    words = F.when(key % 5 != 0, F.split("p_name", " "))
    flag = F.element_at(F.array(*[F.lit(x) for x in ("TRUE", "false", " True ", "1", "yes")]), (key % 5 + 1).cast("int"))
    day = F.date_add(F.lit("1998-03-20").cast("date"), (key % 30).cast("int"))
    zoned = F.concat(day.cast("string"), F.lit(" 23:30:00"), F.when(key % 2 == 0, "+02:00").otherwise("-05:00"))
    return part.select(
        "p_partkey", F.split("p_brand", "#")[1].alias("brand_no"), split_part_safe("p_name", " ", 1).alias("second_word"),
        split_part_safe("p_name", " ", 9).alias("tenth_word"), array_to_string_strict(words, "|").alias("joined"),
        size_or_null(words).cast("bigint").alias("n_words"), text_to_bool(flag).alias("is_flagged"),
        strict_least(size, F.when(key % 3 != 0, key)).alias("least_of_both"), day.cast("timestamp").alias("day_start"),
        zoned.cast("timestamp").alias("zoned_at"), (zoned.cast("timestamp") >= F.lit("1998-03-29 03:00:00 Europe/Berlin").cast("timestamp")).alias("in_summer_time"))
