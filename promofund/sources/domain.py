"""Domain views over the input tables (FIXTURES.md §3).

The settlement jobs speak of entities, order lines, campaigns, benefit
contracts and suppliers. The input is a TPC-H-like star schema, so this module
derives the domain from it with plain column expressions. Every derivation
here has an SQL twin in ``oracle_queries.py``; keep the two in step.

Scale notes: ``nation`` and ``region`` have a fixed size at every scale factor
(25 and 5 rows) and are broadcast. ``customer``, ``part`` and ``supplier``
grow with the data and are joined by shuffle unless AQE measures them small.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promofund.sources.sinks import materialize
from promofund.sources.tables import folder_state, scan

_MEMO: dict[tuple, DataFrame] = {}


def per_session(fn):
    """Build a domain view once per (session, state of the input folder,
    arguments): when files of the folder change, the view is built anew.

    DataFrames are immutable plans; reusing the same object lets later
    queries skip re-analysing its (large) expression trees on the driver.
    """
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kwargs):
        key = (fn.__name__, spark.sparkContext.applicationId, id(spark), sf_dir, folder_state(spark, sf_dir), args, tuple(sorted(kwargs.items())))
        df = _MEMO.get(key)
        if df is None:
            df = fn(spark, sf_dir, *args, **kwargs)
            _MEMO[key] = df
        return df
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper

MONEY = "decimal(18,2)"
# Fixed anchor of the derived campaign calendar.
CAMPAIGN_EPOCH = _dt.date(1995, 1, 1)
N_WAREHOUSES = 5
# Derived vendors: branches a nation, each in at most one warehouse.
VENDORS_PER_NATION = 10


@per_session
def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (c_custkey, global_entity_id, country_code, nationkey).

    Entity = region name, country = first two letters of it, lower case.
    nation/region are fixed 25/5-row tables: broadcast is bounded.
    """
    cust = scan(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = scan(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = scan(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return (cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey)
            .select("c_custkey",
                    F.col("r_name").alias("global_entity_id"),
                    F.lower(F.substring("r_name", 1, 2)).alias("country_code"),
                    F.col("c_nationkey").cast("bigint").alias("nationkey")))


def line_money(l_extendedprice: str = "l_extendedprice", l_discount: str = "l_discount"):
    """Money columns of an order line, exact in decimal(18,2).

    ``discount_rate`` maps -0.0 to 0.0 so sign of zero never leaks out.
    """
    rate = F.when(F.col(l_discount) > 0, F.col(l_discount)).otherwise(F.lit(0.0))
    total = F.col(l_extendedprice).cast(MONEY)
    disc = F.round(total * rate.cast("decimal(4,2)"), 2).cast(MONEY)
    return rate, total, disc


@per_session
def order_lines(spark: SparkSession, sf_dir: str, with_part: bool = True,
                since: _dt.date | None = None) -> DataFrame:
    """One row per line item, with its order header, entity and warehouse.

    Columns: order_id, order_date, order_month, global_entity_id, country_code,
    warehouse_id, warehouse_name, platform_vendor_id (a branch of the customer's
    nation, in that warehouse), is_successful, sku, supplier_id (bigint),
    quantity_sold (bigint), unit_price_listed_lc, unit_discount_lc (double),
    has_discount, line_total_lc, line_discount_lc, net_sales_lc (decimal),
    and when ``with_part``: campaign_id (the promo-tool campaign applied to
    the line) and funding_v1_lc (the promo tool's own funding figure).
    """
    li = scan(spark, sf_dir, "lineitem",
              ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"])
    orders = scan(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    if since is not None:
        # a literal bound on the raw column: pushed into the parquet scan
        # (row-group / partition pruning), not applied after the joins
        orders = orders.where(F.col("o_orderdate") >= F.lit(_dt.datetime.combine(since, _dt.time())).cast("timestamp_ntz"))
    ent = entities(spark, sf_dir)
    hdr = (orders.join(ent, orders.o_custkey == ent.c_custkey)
           .select(F.col("o_orderkey").alias("order_id"),
                   F.col("o_orderdate").cast("date").alias("order_date"),
                   "global_entity_id", "country_code",
                   F.concat(F.lit("W"), (F.col("o_custkey") % N_WAREHOUSES).cast("string")).alias("warehouse_id"),
                   F.concat(F.lit("V"), F.col("nationkey").cast("string"), F.lit("-"),
                            (F.col("o_custkey") % VENDORS_PER_NATION).cast("string")).alias("platform_vendor_id"),
                   (F.col("o_orderstatus") != "F").alias("is_successful")))
    # the joins move only the six raw line columns; every derived column is
    # computed after them, so the shuffles stay as narrow as the input
    lines = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"),
                      F.col("l_suppkey").alias("supplier_id"), "l_quantity", "l_extendedprice", "l_discount")
    out = lines.join(hdr, "order_id")
    if with_part:
        part = scan(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
        brand_no = F.substring("p_brand", 7, 8)
        part = part.select(
            F.col("p_partkey").alias("sku"),
            F.concat(F.lit("C1-"), brand_no, F.lit("-"), (F.col("p_size") % 4).cast("string")).alias("promo_campaign_id"),
            (F.col("p_size") % 2 == 0).alias("_v1_funded"))
        out = out.join(part, "sku", "left")
    rate, total, disc = line_money()
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    cols = [
        "order_id", "sku", "supplier_id",
        F.col("l_quantity").cast("bigint").alias("quantity_sold"),
        "l_extendedprice",
        rate.alias("discount_rate"),
        unit.alias("unit_price_listed_lc"),
        (unit * rate).alias("unit_discount_lc"),
        (rate > 0).alias("has_discount"),
        total.alias("line_total_lc"),
        disc.alias("line_discount_lc"),
        (total - disc).cast(MONEY).alias("net_sales_lc"),
        "order_date", "global_entity_id", "country_code", "warehouse_id",
        F.concat(F.lit("Warehouse "), F.substring("warehouse_id", 2, 8)).alias("warehouse_name"),
        "platform_vendor_id", "is_successful",
    ]
    if with_part:
        cols += [F.when(rate > 0, F.col("promo_campaign_id")).alias("campaign_id"),
                 F.when(F.col("_v1_funded"), F.round(disc * F.lit(Decimal("0.5")), 2).cast(MONEY)).alias("funding_v1_lc")]
    return out.select(*cols, F.trunc("order_date", "month").alias("order_month"))


@per_session
def raw_campaign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (part, campaign family): the raw promo-tool campaign
    attributes implied by that part. Family 1: brand x size%4 (every part);
    family 2: type x size%3 (even part keys only, so campaigns overlap)."""
    part = scan(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    b1 = F.col("p_size") % 4
    k1 = F.substring("p_brand", 7, 8).cast("int")
    fam1 = part.select(
        F.lit(1).alias("family"), "p_partkey", "p_size", "p_retailprice",
        F.concat(F.lit("C1-"), k1.cast("string"), F.lit("-"), b1.cast("string")).alias("campaign_id"),
        F.concat(F.lit("C1-"), k1.cast("string"), F.lit("-0")).alias("root_id"),
        F.concat(F.col("p_brand"), F.lit(" promo "), b1.cast("string")).alias("campaign_name"),
        F.when(b1 <= 1, F.lit("Strikethrough")).when(b1 == 2, F.lit("SameItemBundle"))
         .otherwise(F.lit("GENERIC")).alias("raw_type"),
        F.when(b1 == 1, F.lit("CHEAPEST_PRODUCTS")).otherwise(F.lit("PRODUCTS")).alias("applies_to"),
        F.when(b1 % 2 == 0, F.lit("PERCENTAGE")).otherwise(F.lit("ABSOLUTE")).alias("discount_type"),
        F.when(b1 == 2, F.lit(100.0)).otherwise((b1 + 1) * 10.0).cast("double").alias("discount_value"),
        (k1 * 80 + b1 * 20).alias("start_offset"),
        (b1 * 300 + 400).alias("length_days"),
        F.when((k1 % 7 == 0) & (b1 == 3), F.lit("PAUSED")).otherwise(F.lit("READY")).alias("state"),
        F.lit(True).alias("is_valid"),
        F.when(b1 == 3, F.lit(0)).otherwise(b1 + 1).cast("bigint").alias("trigger_qty_threshold"),
        F.when(b1 == 1, F.lit(0)).when(b1 >= 2, b1 - 1).cast("bigint").alias("benefit_qty_limit"),
    )
    b2 = F.col("p_size") % 3
    k2 = F.length("p_type")
    fam2 = part.where(F.col("p_partkey") % 2 == 0).select(
        F.lit(2).alias("family"), "p_partkey", "p_size", "p_retailprice",
        F.concat(F.lit("C2-"), F.col("p_type"), F.lit("-"), b2.cast("string")).alias("campaign_id"),
        F.concat(F.lit("C2-"), F.col("p_type"), F.lit("-0")).alias("root_id"),
        F.concat(F.col("p_type"), F.lit(" bundle "), b2.cast("string")).alias("campaign_name"),
        F.when(b2 == 1, F.lit("BasketValue")).otherwise(F.lit("MixAndMatch")).alias("raw_type"),
        F.when(b2 == 1, F.lit("BASKET")).when(b2 == 2, F.lit("DELIVERY_FEE"))
         .otherwise(F.lit("PRODUCTS")).alias("applies_to"),
        F.when(b2 == 1, F.lit("ABSOLUTE")).otherwise(F.lit("PERCENTAGE")).alias("discount_type"),
        F.when(b2 == 0, F.lit(100.0)).when(b2 == 1, F.lit(5.0)).otherwise(F.lit(50.0)).alias("discount_value"),
        (k2 * 80 + b2 * 20).alias("start_offset"),
        (b2 * 300 + 400).alias("length_days"),
        F.lit("READY").alias("state"),
        (~((F.col("p_type") == "PROMO") & (b2 == 2))).alias("is_valid"),
        (b2 + 2).cast("bigint").alias("trigger_qty_threshold"),
        F.lit(1).cast("bigint").alias("benefit_qty_limit"),
    )
    rows = fam1.unionByName(fam2)
    start = F.date_add(F.lit(CAMPAIGN_EPOCH), F.col("start_offset"))
    return (rows.withColumn("start_date", start)
            .withColumn("end_date", F.date_add(start, F.col("length_days")))
            .drop("start_offset", "length_days"))


@per_session
def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean campaigns (L4 semantics applied to the derived raw rows): one row
    per campaign_id with normalised type (C14) and subtype (C13).

    All attributes are functions of campaign_id, so DISTINCT is exact; it runs
    as a partial (map-side) aggregate before the shuffle.
    """
    from promofund.functions.rules import campaign_subtype, normalise_campaign_type
    raw = raw_campaign_rows(spark, sf_dir).select(
        "family", "campaign_id", "root_id", "campaign_name", "raw_type", "applies_to",
        "discount_type", "discount_value", "start_date", "end_date", "state", "is_valid",
        "trigger_qty_threshold", "benefit_qty_limit").distinct()
    ctype = normalise_campaign_type("raw_type")
    return materialize(raw.select(
        "family", "campaign_id", "root_id", "campaign_name",
        ctype.alias("campaign_type"),
        campaign_subtype(ctype, F.col("applies_to"), F.col("discount_type"), F.col("discount_value"))
        .alias("campaign_subtype"),
        "applies_to", "discount_type", "discount_value",
        F.col("start_date").cast("timestamp_ntz").alias("start_at_utc"),
        F.col("end_date").cast("timestamp_ntz").alias("end_at_utc"),
        "start_date", "end_date", "state", "is_valid",
        "trigger_qty_threshold", "benefit_qty_limit"))


@per_session
def benefits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benefit contracts per (campaign_id, sku) (the nested ``benefits`` of a
    curated campaign, unnested). Family 1 contract by ``p_size % 5``:
    0 none, 1 PERCENTAGE 10, 4 ABSOLUTE 0, else ABSOLUTE 5% of retail price.
    Family 2 covers the odd truth-table rows: (NULL,3), (ABSOLUTE,NULL),
    (ABSOLUTE,-1), ABSOLUTE 3%, (NULL,0)."""
    rows = raw_campaign_rows(spark, sf_dir)
    c = F.col("p_size") % 5
    retail = F.col("p_retailprice").cast(MONEY)
    f1 = F.col("family") == 1
    ftype = (F.when(f1, F.when(c == 0, F.lit(None)).when(c == 1, F.lit("PERCENTAGE"))
                    .otherwise(F.lit("ABSOLUTE")))
             .otherwise(F.when(c.isin(1, 2, 3), F.lit("ABSOLUTE"))))
    fvalue = (F.when(f1, F.when(c == 0, F.lit(None)).when(c == 1, F.lit(Decimal("10.00")))
                     .when(c == 4, F.lit(Decimal("0.00")))
                     .otherwise(F.round(retail * F.lit(Decimal("0.05")), 2)))
              .otherwise(F.when(c == 0, F.lit(Decimal("3.00"))).when(c == 2, F.lit(Decimal("-1.00")))
                         .when(c == 3, F.round(retail * F.lit(Decimal("0.03")), 2))
                         .when(c == 4, F.lit(Decimal("0.00")))))
    return materialize(rows.select(
        "campaign_id",
        F.col("p_partkey").alias("sku"),
        ftype.cast("string").alias("supplier_funding_type"),
        fvalue.cast(MONEY).alias("supplier_funding_value"),
        F.when(f1 & (c >= 2), F.lit("ABSOLUTE")).alias("discount_type_sku"),
        F.when(f1 & (c >= 2), F.round(retail * F.lit(Decimal("0.10")), 2)).cast(MONEY).alias("discount_value_sku"),
        (F.col("p_partkey") % 97 == 13).alias("is_deleted"),
    ))


# ------------------------------------------------------------------ entity and warehouse scope (v2)


@per_session
def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches of an entity: (global_entity_id, country_code, nationkey, branch,
    catalog_global_vendor_id, warehouse_id, warehouse_name, is_dmart).

    Ten per nation, so 250 rows at every scale. A closed branch has no warehouse
    (NULL or an empty string), and some branches are no dark stores."""
    nation = scan(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = scan(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    n, k = F.col("n_nationkey"), F.col("branch")
    rows = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(VENDORS_PER_NATION - 1)))))
    warehouse = (F.when((n + 3 * k) % 13 == 6, F.lit(None)).when((n + k) % 11 == 0, F.lit(""))
                 .otherwise(F.concat(F.lit("W"), (k % N_WAREHOUSES).cast("string"))))
    return materialize(rows.select(
        F.col("r_name").alias("global_entity_id"), F.lower(F.substring("r_name", 1, 2)).alias("country_code"),
        n.cast("bigint").alias("nationkey"), k.cast("bigint").alias("branch"),
        F.concat(F.lit("V"), n.cast("string"), F.lit("-"), k.cast("string")).alias("catalog_global_vendor_id"),
        warehouse.alias("warehouse_id"), F.concat(F.lit("Warehouse "), F.substring(warehouse, 2, 8)).alias("warehouse_name"),
        ((n + 2 * k) % 7 != 0).alias("is_dmart")))


@per_session
def supplied_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DISTINCT (sku, supplier_id) of the order lines, written once."""
    li = scan(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey"])
    return materialize(li.select(F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("supplier_id")).distinct())


@per_session
def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue per (global_entity_id, sku) with ``vendor_products[]``: the
    branches that list the SKU (those of the suppliers that supply it). The array
    is bounded by the entity's branches."""
    sup = scan(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    listed = (supplied_pairs(spark, sf_dir).join(sup, F.col("supplier_id") == F.col("s_suppkey"))
              .select("sku", F.col("s_nationkey").cast("bigint").alias("nationkey"),
                      (F.col("s_suppkey") % VENDORS_PER_NATION).cast("bigint").alias("branch")).distinct())
    entry = F.struct("catalog_global_vendor_id", "warehouse_id", "warehouse_name", "is_dmart")
    return materialize(listed.join(F.broadcast(vendors(spark, sf_dir)), ["nationkey", "branch"])
                       .groupBy("global_entity_id", "sku").agg(F.sort_array(F.collect_set(entry)).alias("vendor_products")))


def dmart_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue unnested (D17) to products of open dark-store branches:
    (global_entity_id, sku, catalog_global_vendor_id, warehouse_id, warehouse_name)."""
    rows = catalogue(spark, sf_dir).select("global_entity_id", "sku", F.inline("vendor_products"))
    return rows.where((F.col("is_dmart") == True) & F.col("warehouse_id").isNotNull() & (F.col("warehouse_id") != "")  # noqa: E712
                      ).drop("is_dmart")


@per_session
def entity_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean campaigns as the entities run them, key (global_entity_id,
    campaign_id), with ``vendors[]`` (an empty array: the campaign runs nowhere).

    A campaign belongs to the entity (its number + its bucket) % 5, the number
    being the brand's or the length of the type; bundles of bucket 0 run under
    the same id in a second entity. It runs at the branches with
    (nation + branch + number + bucket) % 8 = 0; reason and creation day follow
    from number + bucket."""
    region = scan(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    middle = F.expr("substring(campaign_id, 4, length(campaign_id) - 5)")
    number = F.when(F.col("family") == 1, middle.try_cast("int")).otherwise(F.length(middle))
    bucket = F.right("campaign_id", F.lit(1)).cast("int")
    home = (number + bucket) % 5
    regions = F.when((F.col("family") == 2) & (bucket == 0), F.array(home, (home + 2) % 5)).otherwise(F.array(home))
    ec = (campaigns(spark, sf_dir).withColumn("step", number + bucket).withColumn("regionkey", F.explode(regions))
          .join(F.broadcast(region), F.col("regionkey") == F.col("r_regionkey"))
          .withColumnsRenamed({"r_name": "global_entity_id"}).drop("regionkey", "r_regionkey"))
    ven = vendors(spark, sf_dir).select("global_entity_id", "nationkey", "branch", "catalog_global_vendor_id")
    at = (ec.select("global_entity_id", "campaign_id", "step").join(F.broadcast(ven), "global_entity_id")
          .where((F.col("nationkey") + F.col("branch") + F.col("step")) % 8 == 0)
          .groupBy("global_entity_id", "campaign_id")
          .agg(F.sort_array(F.collect_list(F.struct("catalog_global_vendor_id"))).alias("vendors")))
    # why and when the campaign was made
    ec = (ec.withColumn("reason", F.when(F.col("step") % 3 != 0, F.concat(F.lit("R"), (F.col("step") % 3).cast("string"))))
          .withColumn("created_at_utc", F.date_sub("start_date", (F.col("step") % 20).cast("int")).cast("timestamp_ntz")))
    out = ec.drop("step").join(at, ["global_entity_id", "campaign_id"], "left")
    none = F.array().cast("array<struct<catalog_global_vendor_id:string>>")
    return materialize(out.withColumn("vendors", F.coalesce("vendors", none))
                       .withColumn("country_code", F.lower(F.substring("global_entity_id", 1, 2))))


# ------------------------------------------------------------------ config
CONFIG_SCHEMA = T.StructType([
    T.StructField("global_entity_id", T.StringType(), False, {"comment": "entity code"}),
    T.StructField("country_code", T.StringType(), True, {"comment": "country code"}),
    T.StructField("join_strategy", T.StringType(), True,
                  {"comment": "'date_warehouse_sku' or 'campaign_id': how order lines meet campaign rules"}),
    T.StructField("require_discount_to_charge", T.BooleanType(), True,
                  {"comment": "TRUE: charge only lines that carry a discount"}),
    T.StructField("missing_contract_fallback", T.StringType(), True,
                  {"comment": "'skip' or 'full_discount' when the contract is missing"}),
    T.StructField("funding_value_convention", T.StringType(), True,
                  {"comment": "'normalized' (unit x qty) or 'per_benefit' (unit x times triggered)"}),
    T.StructField("funding_source", T.StringType(), True,
                  {"comment": "'negotiated' (contracts) or 'promotool' (legacy v1 amounts)"}),
    T.StructField("param_billing_period", T.StringType(), True,
                  {"comment": "'order_date' or 'campaign_end_date': basis of the billing month"}),
    T.StructField("is_active", T.BooleanType(), True, {"comment": "use this row"}),
    T.StructField("updated_at", T.TimestampNTZType(), True, {"comment": "last change"}),
])

# One row per entity; the entity set is the config's own bound (a few dozen
# countries at most), which is why config joins are broadcast.
CONFIG_ROWS = (
    ("AFRICA", "af", "date_warehouse_sku", True, "skip", "normalized", "negotiated", "order_date", True),
    ("AMERICA", "am", "date_warehouse_sku", False, "full_discount", "per_benefit", "negotiated", "campaign_end_date", True),
    ("ASIA", "as", "campaign_id", True, "full_discount", "per_benefit", "negotiated", "order_date", True),
    ("EUROPE", "eu", "date_warehouse_sku", False, "skip", "normalized", "promotool", "order_date", True),
    ("MIDDLE EAST", "mi", "date_warehouse_sku", True, "skip", "legacy", "negotiated", "campaign_end_date", True),
    ("ANTARCTICA", "an", "date_warehouse_sku", True, "skip", "normalized", "negotiated", "order_date", False),
)
CONFIG_UPDATED_AT = _dt.datetime(2025, 1, 1)


def config(spark: SparkSession, rows=CONFIG_ROWS, active_only: bool = True) -> DataFrame:
    """The per-entity behaviour table, typed, with column comments."""
    df = spark.createDataFrame([r + (CONFIG_UPDATED_AT,) for r in rows], CONFIG_SCHEMA)
    return df.where(F.col("is_active") == True) if active_only else df  # noqa: E712


def enabled_entities(spark: SparkSession, entity_ids) -> DataFrame:
    """A2: an inline list as a one-column table."""
    return spark.createDataFrame([(e,) for e in entity_ids], "global_entity_id string")
