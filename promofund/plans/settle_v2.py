"""Settlement v2 (L24–L29): config-driven, all entities in one run.

T1 campaigns in use -> T2 funding rules -> [T3 daily grid] -> T4 order funding
-> T5 billing. Each step is a lazy DataFrame; only T4/T5 are meant to be
written. T4 joins order lines to rules with an interval join instead of
materialising the campaign x sku x day grid (the grid is kept as ``daily_grid``
for output parity and as the second form of T4).

Shuffle plan of T4 at scale:
  lines: lineitem x orders (order key) x customer (cust key) x part (sku)
  rules: campaign x sku x warehouse
  interval join on (entity, warehouse,   -> one shuffle of the lines; a hot SKU spreads
                    sku)                    over entities and warehouses, AQE splits
                                            what is still skewed. Buckets of years would
                                            repeat rules (x2-4) and suppliers (x7)
  top-1 per (entity, warehouse, sku,     -> reuses that partitioning
             order)
  supplier join on (entity, warehouse,   -> reuses that partitioning
                    sku)
  config / campaign dimensions           -> broadcast (bounded by entity / campaign count)
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions import rules as R
from promofund.functions.windows import billing_basis, date_array, local_date, overlaps
from promofund.operators.dedup import top1
from promofund.operators.intervals import interval_join
from promofund.operators.joins import checked_broadcast
from promofund.plans import curate
from promofund.sources import domain
from promofund.sources.sinks import materialize

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Horizon:
    """The fixed settlement horizon ``[date_in, date_fin]``."""
    date_in: _dt.date = _dt.date(1995, 1, 1)
    date_fin: _dt.date = _dt.date(2001, 12, 31)


def _active(cfg: DataFrame) -> DataFrame:
    """Entity and country of the active config rows: one row per entity."""
    return F.broadcast(cfg.select("global_entity_id", F.col("country_code").alias("cfg_country_code")))


def campaigns_in_use(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(), cfg: DataFrame | None = None) -> DataFrame:
    """T1 (L24): READY, valid campaigns of the active entities that overlap the
    horizon and have a benefit SKU which an open dark-store branch of the same
    entity lists (semi joins, no fan-out). Key (global_entity_id, campaign_id)."""
    cfg = cfg if cfg is not None else domain.config(spark)
    camp = domain.entity_campaigns(spark, sf_dir).join(_active(cfg), "global_entity_id").drop("cfg_country_code")
    camp = camp.where((F.col("state") == "READY") & (F.col("is_valid") == True)  # noqa: E712
                      & overlaps(F.col("start_at_utc"), F.col("end_at_utc"),
                                 F.lit(h.date_in).cast("timestamp_ntz"), F.lit(h.date_fin).cast("timestamp_ntz")))
    skus = domain.dmart_products(spark, sf_dir).select("global_entity_id", "sku").distinct()
    ben = domain.benefits(spark, sf_dir).select("campaign_id", "sku")
    used = (camp.select("global_entity_id", "campaign_id").join(ben, "campaign_id")
            .join(skus, ["global_entity_id", "sku"], "left_semi").select("global_entity_id", "campaign_id"))
    return camp.join(used, ["global_entity_id", "campaign_id"], "left_semi")


@domain.per_session
def funding_rules(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(),
                  t1: DataFrame | None = None) -> DataFrame:
    """T2 (L25): one rule per (entity, campaign, sku) with contract status (C17),
    unit value (C18) and resolved discount (C19); soft-deleted contracts dropped."""
    t1 = t1 if t1 is not None else campaigns_in_use(spark, sf_dir, h)
    ben = domain.benefits(spark, sf_dir)
    c = t1.select("global_entity_id", "country_code", "campaign_id", "campaign_type", "discount_type", "discount_value",
                  "trigger_qty_threshold", "benefit_qty_limit", "start_date", "end_date")
    j = c.join(ben, "campaign_id").where(F.col("sku").isNotNull() & (F.col("is_deleted") == False))  # noqa: E712
    # T2 is read by T3, T4 and the quality jobs: written once (lineage cut)
    return materialize(j.select(
        "global_entity_id", "country_code", "campaign_id", "campaign_type", "sku",
        "supplier_funding_type", "supplier_funding_value",
        R.contract_status("supplier_funding_type", "supplier_funding_value").alias("contract_status"),
        R.funding_unit_value("supplier_funding_type", "supplier_funding_value").alias("funding_unit_value"),
        F.coalesce("discount_type_sku", "discount_type").alias("discount_type_resolved"),
        F.coalesce(F.col("discount_value_sku").cast("double"), F.col("discount_value")).alias("discount_value_resolved"),
        "trigger_qty_threshold", "benefit_qty_limit",
        "start_date", F.col("end_date").alias("campaign_end_date")))


def vendor_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge from a vendor to its warehouse: DISTINCT over the open
    dark-store branches of the catalogue. Closed vendors are not in it."""
    return domain.dmart_products(spark, sf_dir).drop("sku").distinct()


@domain.per_session
def campaign_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A campaign's vendors resolved to warehouses: (global_entity_id,
    campaign_id, warehouse_id, warehouse_name, n_vendors). Bounded by campaigns
    times warehouses, whatever the number of SKUs."""
    ec = domain.entity_campaigns(spark, sf_dir).select("global_entity_id", "campaign_id", F.inline_outer("vendors"))
    return materialize(ec.join(vendor_warehouses(spark, sf_dir), ["global_entity_id", "catalog_global_vendor_id"])
                       .groupBy("global_entity_id", "campaign_id", "warehouse_id", "warehouse_name")
                       .agg(F.count(F.lit(1)).alias("n_vendors")))


def daily_grid(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(),
               t2: DataFrame | None = None) -> DataFrame:
    """T3 (L26): one row per (entity, campaign, sku, vendor, day the campaign
    runs), with the vendor's warehouse; vendors of one warehouse give equal rows.

    Days are generated with a guarded ``sequence`` (N1). The grid of all SKUs
    grows with campaign length x SKUs x vendors; ``t2`` may also hold rules that
    are added up per campaign (``daily_grid_summary``)."""
    t2 = t2 if t2 is not None else funding_rules(spark, sf_dir, h)
    at = checked_broadcast(campaign_warehouses(spark, sf_dir))
    return (t2.join(at, ["global_entity_id", "campaign_id"])
            .withColumn("vendor_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_vendors"))))
            .withColumn("order_date", F.explode(date_array(F.col("start_date"), F.col("campaign_end_date"))))
            .drop("start_date", "n_vendors", "vendor_no"))


def daily_grid_summary(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(), t2: DataFrame | None = None) -> DataFrame:
    """T3 summarised per (entity, campaign, warehouse, month): grid rows, SKUs,
    first/last day and the unit values of all rows added up.

    Vendors and days are the same for all SKUs of a campaign that have the same
    validity, so rules and their unit values are added up before the grid
    spreads them over vendors and days. A campaign's SKUs are grouped by the set
    of their validities first: sets share no SKU, so distinct SKUs add up."""
    t2 = t2 if t2 is not None else funding_rules(spark, sf_dir, h)
    campaign = ["global_entity_id", "country_code", "campaign_id"]
    span = F.struct("start_date", "campaign_end_date")
    per_sku = (t2.groupBy(*campaign, "sku", "start_date", "campaign_end_date")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("funding_unit_value").alias("unit_value"))
               .groupBy(*campaign, "sku").agg(F.collect_list(F.struct(span.alias("span"), "n", "unit_value")).alias("parts"))
               .withColumn("spans", F.array_sort(F.transform("parts", lambda p: p["span"]))))
    rules = (per_sku.select(*campaign, "spans", F.inline("parts"))
             .groupBy(*campaign, "spans", "span").agg(F.sum("n").alias("n_rules"), F.count(F.lit(1)).alias("n_skus"),
                                                      F.sum("unit_value").alias("unit_value"))
             .select(*campaign, "spans", "n_rules", "n_skus", "unit_value", "span.*"))
    month = [*campaign, "warehouse_id", "warehouse_name", F.trunc("order_date", "month").alias("grid_month")]
    g = (daily_grid(spark, sf_dir, h, t2=rules).groupBy(*month, "spans")
         .agg(F.sum("n_rules").alias("n_rules"), F.max("n_skus").alias("n_skus"), F.min("order_date").alias("first_day"),
              F.max("order_date").alias("last_day"), F.sum("unit_value").alias("unit_value")))
    return (g.groupBy(*month[:-1], "grid_month")
            .agg(F.sum("n_rules").alias("grid_rows"), F.sum("n_skus").alias("n_skus"), F.min("first_day").alias("first_day"),
                 F.max("last_day").alias("last_day"), F.sum("unit_value").alias("unit_value_days")))


def grid_days(rules: DataFrame, h: Horizon) -> DataFrame:
    """The days of the T3 grid inside the horizon, which all SKUs of a campaign
    with the same validity share: (entity, warehouse, funding_campaign_id, dates,
    grid_date). Bounded by campaigns x warehouses x days, whatever the number of SKUs."""
    days = date_array(F.greatest("start_date", F.lit(h.date_in)), F.least("campaign_end_date", F.lit(h.date_fin)))
    return (rules.select("global_entity_id", "warehouse_id", "funding_campaign_id", "start_date", "campaign_end_date").distinct()
            .withColumn("grid_date", F.explode(days)))


def _order_lines_in_scope(spark, sf_dir, h, cfg, lines=None):
    lines = lines if lines is not None else domain.order_lines(spark, sf_dir)
    lines = lines.where((F.col("is_successful") == True) & (F.col("quantity_sold") > 0)  # noqa: E712
                        & F.col("order_date").between(F.lit(h.date_in), F.lit(h.date_fin)))
    cfg = cfg.select("global_entity_id", F.col("country_code").alias("cfg_country_code"),
                     "join_strategy", "require_discount_to_charge", "missing_contract_fallback",
                     "funding_value_convention", "funding_source", "param_billing_period")
    # config: one row per entity -> bounded broadcast
    return (lines.join(F.broadcast(cfg), "global_entity_id")
            .where(F.col("country_code") == F.col("cfg_country_code")).drop("cfg_country_code"))


_LINE_TIE_BREAK = ("quantity_sold", "l_extendedprice", "discount_rate", "supplier_id")


def supplier_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One supplier per (global_entity_id, warehouse_id, sku), from L19."""
    return curate.entity_suppliers(spark, sf_dir).select(
        "global_entity_id", "warehouse_id", "sku", F.col("supplier_id").alias("info_supplier_id"), "supplier_name").distinct()


def order_funding(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(),
                  t2: DataFrame | None = None, cfg: DataFrame | None = None,
                  use_grid: bool = False, bucket: str | None = None,
                  lines: DataFrame | None = None, line_keys: tuple[str, ...] = ()) -> DataFrame:
    """T4 (L27): fund every successful order line in scope.

    Lines meet rules on (entity, day, warehouse, sku) (D7) and, for entities
    whose strategy is 'campaign_id', also on the promo-tool campaign (D8).
    Overlapping rules are resolved by the highest unit value per (order, sku)
    (F5, N3: two lines of one SKU in an order collapse to one). The supplier is
    that of the line's (entity, warehouse, sku), not the line's own. ``use_grid``
    joins the T3 day grid instead of the interval join; both give the same rows.

    ``lines`` replaces the domain's order lines; columns ``line_keys`` of it then
    belong to the order's key and are returned.
    """
    cfg = cfg if cfg is not None else domain.config(spark)
    t2 = t2 if t2 is not None else funding_rules(spark, sf_dir, h)
    # the warehouse's name comes with the rule that funds the line
    lines = _order_lines_in_scope(spark, sf_dir, h, cfg, lines).drop("warehouse_name")
    keys = ["global_entity_id", "warehouse_id", "sku"]
    at = checked_broadcast(campaign_warehouses(spark, sf_dir).drop("n_vendors"))
    rules = t2.drop("country_code").join(at, ["global_entity_id", "campaign_id"]).withColumnRenamed("campaign_id", "funding_campaign_id")
    strategy = ((F.col("l.join_strategy") != "campaign_id")
                | (F.col("l.campaign_id") == F.col("r.funding_campaign_id")))
    suppliers = supplier_info(spark, sf_dir)
    if use_grid:
        # the grid in its two factors, a campaign's SKUs and its days: a line meets
        # the rules of its (entity, warehouse, sku), then the campaign's days. A
        # rule whose day is not in the grid leaves a row without a rule; those come
        # last below, and a line without any rule has such a row anyway
        days = materialize(grid_days(rules, h)).alias("d")
        l, r = lines.alias("l"), rules.alias("r")
        met = l.join(r, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys] + [strategy], "left").select(
            "l.*", *[F.col(f"r.{c}").alias(c) for c in rules.columns if c not in keys]).alias("m")
        day_keys = ["global_entity_id", "warehouse_id", "funding_campaign_id", "start_date", "campaign_end_date"]
        on = [F.col(f"m.{k}") == F.col(f"d.{k}") for k in day_keys] + [F.col("m.order_date") == F.col("d.grid_date")]
        of_rule = [c for c in rules.columns if c not in keys and c != "start_date"]
        joined = met.join(checked_broadcast(days), on, "left").select(
            *[F.col(f"m.{c}").alias(c) for c in lines.columns],
            *[F.when(F.col("d.grid_date").isNotNull(), F.col(f"m.{c}")).alias(c) for c in of_rule])
        part_keys = [*keys, "order_id"]
    else:
        joined = interval_join(lines, rules, on=keys, point="order_date", start="start_date",
                               end="campaign_end_date", how="left", closed=True, bucket=bucket,
                               extra=strategy, keep_bucket=True).drop("start_date")
        # the order's entity, warehouse and bucket are functions of order_id:
        # adding the join's keys to the window keys lets the window reuse the
        # join's hash partitioning (no second shuffle) without changing the groups
        part_keys = [*keys, "__bucket", "order_id"] if bucket else [*keys, "order_id"]
    if bucket == "year" and not use_grid:
        # a supplier a year of the horizon: the lookup too reuses the lines' partitioning
        years = F.sequence(F.lit(h.date_in.replace(month=1, day=1)), F.lit(h.date_fin.replace(month=1, day=1)), F.expr("interval 1 year"))
        suppliers = suppliers.withColumn("__bucket", F.explode(years))
        keys = [*keys, "__bucket"]
    best = top1(joined, [*part_keys, *line_keys],
                [F.col("funding_unit_value").desc_nulls_last()],
                [F.col("funding_campaign_id").asc_nulls_last(),
                 *[F.col(c).desc() for c in _LINE_TIE_BREAK[:-1]], F.col("supplier_id").asc()])
    funded = best.withColumn("funding_total_lc", R.funding_total(
        require_discount="require_discount_to_charge", has_discount="has_discount",
        status="contract_status", fallback="missing_contract_fallback",
        unit_value="funding_unit_value", convention="funding_value_convention",
        quantity="quantity_sold", full_discount_amount="line_discount_lc",
        threshold="trigger_qty_threshold", limit="benefit_qty_limit"))
    amount, delta = R.source_switch("funding_source", "funding_total_lc", "funding_v1_lc")
    funded = funded.withColumn("funding_amount_lc", amount).withColumn("delta_lc", delta)

    # the campaign table is a written step table: its size is checked before it
    # is broadcast to both dimension joins
    camp = checked_broadcast(domain.entity_campaigns(spark, sf_dir).select("global_entity_id", "campaign_id", "root_id", "campaign_subtype"))
    audit = camp.select(F.col("global_entity_id").alias("a_entity"), F.col("campaign_id").alias("a_cid"), "root_id", "campaign_subtype")
    fund = camp.select(F.col("global_entity_id").alias("f_entity"), F.col("campaign_id").alias("f_cid"),
                       F.col("root_id").alias("funding_root_id"), F.col("campaign_subtype").alias("funding_campaign_subtype"))
    out = (funded.join(suppliers, keys, "left")
           .join(audit, (F.col("global_entity_id") == F.col("a_entity")) & (F.col("campaign_id") == F.col("a_cid")), "left")
           .join(fund, (F.col("global_entity_id") == F.col("f_entity")) & (F.col("funding_campaign_id") == F.col("f_cid")), "left"))
    return out.select(
        "global_entity_id", "order_id", "order_date", "warehouse_id",
        F.col("info_supplier_id").cast("string").alias("supplier_id"), "supplier_name",
        "sku", "campaign_id", "funding_campaign_id", "root_id", "funding_root_id",
        "campaign_type", "campaign_subtype", "funding_campaign_subtype",
        "quantity_sold", "unit_price_listed_lc", "unit_discount_lc", "net_sales_lc", "has_discount",
        "contract_status", "supplier_funding_type", "supplier_funding_value", "funding_unit_value",
        "trigger_qty_threshold", "benefit_qty_limit", "discount_type_resolved", "discount_value_resolved",
        "campaign_end_date", "warehouse_name", "funding_total_lc", "funding_amount_lc",
        F.coalesce(F.col("funding_v1_lc"), F.lit(0).cast(MONEY)).alias("funding_v1_lc"), "delta_lc",
        (F.col("contract_status") == R.STATUS_MISSING).alias("fallback_applied"),
        F.col("join_strategy").alias("join_method_used"),
        F.col("funding_value_convention").alias("funding_value_convention_used"),
        "param_billing_period", *line_keys)


# The entities' time zones.
ENTITY_ZONES = {"AFRICA": "Africa/Cairo", "AMERICA": "America/New_York", "ASIA": "Asia/Tokyo", "EUROPE": "Europe/Berlin",
                "MIDDLE EAST": "Asia/Dubai"}


def local_day_funding(spark: SparkSession, sf_dir: str, h: Horizon = Horizon()) -> DataFrame:
    """Orders whose local day isn't their UTC day, funded by either.

    Rules hold on UTC days, orders are settled by the local day of their entity
    (daylight saving included), so an order near midnight meets the rules of
    another day. Each line is funded for both days in one pass of T4, the kind
    of day being part of the order's key; returned are the (order, sku) whose
    days differ, with the rule and the amount by each day (NULL: that day is
    outside the horizon). The instant of an order is its day plus
    (order_id * 7919) % 86400 seconds UTC."""
    zones = F.create_map(*[F.lit(x) for pair in ENTITY_ZONES.items() for x in pair])
    instant = (F.unix_seconds(F.col("order_date").cast("timestamp")) + (F.col("order_id") * 7919) % 86400).cast("timestamp")
    lines = (domain.order_lines(spark, sf_dir).withColumn("order_date_lt", local_date(instant, zones[F.col("global_entity_id")]))
             .where(F.col("order_date_lt") != F.col("order_date")))
    both = F.array(F.struct(F.lit("utc").alias("day_kind"), F.col("order_date").alias("day")),
                   F.struct(F.lit("local").alias("day_kind"), F.col("order_date_lt").alias("day")))
    lines = lines.select("*", F.inline(both)).withColumn("order_date", F.col("day")).drop("day", "order_date_lt")
    t4 = order_funding(spark, sf_dir, h, lines=lines, line_keys=("day_kind",))

    def by(kind, column):
        return F.max(F.when(F.col("day_kind") == kind, F.col(column)))

    return t4.groupBy("global_entity_id", "order_id", "sku").agg(
        by("utc", "order_date").alias("order_date_utc"), by("local", "order_date").alias("order_date_lt"),
        by("utc", "funding_campaign_id").alias("campaign_by_utc_day"), by("local", "funding_campaign_id").alias("campaign_by_local_day"),
        by("utc", "funding_amount_lc").alias("amount_by_utc_day"), by("local", "funding_amount_lc").alias("amount_by_local_day"))


def billing_output(spark: SparkSession, sf_dir: str, h: Horizon = Horizon(),
                   t4: DataFrame | None = None, as_of: _dt.date | None = None) -> DataFrame:
    """T5 (L28/E15): monthly billing per (entity, month, supplier, warehouse),
    only rows with funding > 0. Distinct counts (E5) plan as one Expand +
    two-phase aggregate; money sums stay decimal until the final cast."""
    t4 = t4 if t4 is not None else order_funding(spark, sf_dir, h)
    basis = billing_basis(F.col("param_billing_period"), F.col("order_date"), F.col("campaign_end_date"))
    pre = (t4.where(basis.between(F.lit(h.date_in), F.lit(h.date_fin)) & (F.col("funding_amount_lc") > 0))
           .withColumn("billing_month", F.trunc(basis, "month")))
    out = (pre.groupBy("global_entity_id", "billing_month", "supplier_id", "supplier_name",
                       "warehouse_id", "warehouse_name")
           .agg(F.countDistinct("order_id").alias("total_orders"),
                F.countDistinct("sku").alias("total_skus"),
                F.countDistinct("campaign_id").alias("total_campaigns"),
                F.round(F.sum("funding_amount_lc"), 2).alias("total_funding_v2_lc"),
                F.round(F.sum("funding_v1_lc"), 2).alias("total_funding_v1_lc"),
                F.round(F.sum("delta_lc"), 2).alias("total_delta_lc"),
                F.count_if(F.col("fallback_applied") == True).alias("fallback_orders")))  # noqa: E712
    if as_of is not None:
        out = out.withColumn("run_date", F.lit(as_of))
    return out.withColumn("settlement_version", F.lit("v2"))


def run_settlement(spark: SparkSession, sf_dir: str, out_dir: str, as_of: _dt.datetime,
                   h: Horizon) -> dict[str, str]:
    """The v2 job as scheduled: every step writes its table (full replace,
    clustered, A6) and the next step reads it, so each step is one restartable
    Spark job and a lost executor never re-runs an earlier step.

    T2 is clustered by (campaign, sku), T4 by (entity, order date, supplier)
    with the entity as a folder partition, T5 by (entity, month, supplier).
    Returns the table folders.
    """
    from promofund.session import size_shuffles
    from promofund.sources.sinks import stamp, write_clustered
    from promofund.sources.tables import table_path
    import os
    # shuffle width from the volume of the fact and dimension inputs
    size_shuffles(spark, [table_path(sf_dir, t) for t in ("lineitem", "orders", "customer", "part", "supplier")])
    paths = {k: os.path.join(out_dir, k) for k in ("funding_rules", "order_funding", "billing_output", "health")}
    write_clustered(stamp(funding_rules(spark, sf_dir, h), as_of), paths["funding_rules"], ["campaign_id", "sku"])
    t2 = spark.read.parquet(paths["funding_rules"]).drop("ingested_at")
    write_clustered(stamp(order_funding(spark, sf_dir, h, t2=t2), as_of), paths["order_funding"],
                    ["order_date", "supplier_id"], partition_by=["global_entity_id"])
    t4 = spark.read.parquet(paths["order_funding"]).drop("ingested_at")
    write_clustered(billing_output(spark, sf_dir, h, t4=t4, as_of=as_of.date()), paths["billing_output"],
                    ["global_entity_id", "billing_month", "supplier_id"])
    # M4 on the written tables: two aggregate passes, a handful of rows out
    from promofund.plans.health import health_report
    t5 = spark.read.parquet(paths["billing_output"])
    stamp(health_report(spark, sf_dir, t4=t4, t5=t5), as_of).coalesce(1).write.mode("overwrite").parquet(paths["health"])
    return paths
