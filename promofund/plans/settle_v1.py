"""Settlement v1 (L18–L22): window-driven weekly / monthly statements.

Runs are the scheduled ones — every Monday (weekly job) and every 1st of a
month (monthly job) among the order dates — and all of them are evaluated in
one pass: each run's settlement window (B3) selects the campaigns that
concluded in it; their order lines inside the rolling horizon (B6) are
charged; the charges roll up per SKU (L21) and nest into per-supplier
statements (L22).

Scale: the window table and the campaign table are small (runs x campaigns);
the only large side is the order lines, joined once on campaign id (a
broadcast when AQE measures the campaign side small, else a shuffle on
campaign id with AQE splitting hot campaigns).
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions import rules as R
from promofund.functions import windows as Wn
from promofund.operators.joins import checked_broadcast
from promofund.operators.nested import nest
from promofund.plans import calendar, curate
from promofund.sources import domain
from promofund.sources.sinks import materialize

MONEY = "decimal(18,2)"
# Campaign type whose charge is the discount itself, not the supplier-funded
# amount (C22). The reference names its type 'GroupValue'; in the derived
# domain the bundle type plays that role.
DISCOUNT_CHARGED_TYPE = "SameItemBundle"
# Fixed exclusion (C6): in this entity, campaigns whose name matches are not settled.
EXCLUDED_ENTITY, EXCLUDED_NAMES = "MIDDLE EAST", "brand#1|small bundle"
# The entities' currencies.
CURRENCIES = {"AFRICA": "EGP", "AMERICA": "USD", "ASIA": "JPY", "EUROPE": "EUR", "MIDDLE EAST": "AED"}
# Entities the v1 settlement runs for (A2: the enabled-entities list).
ENABLED_ENTITIES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _add_months(d: _dt.date, months: int) -> _dt.date:
    """Calendar month arithmetic clamped to the month end (as add_months)."""
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    nxt = _dt.date(y + (m + 1) // 12, (m + 1) % 12 + 1, 1)
    return min(d.replace(year=y, month=m + 1, day=1) + _dt.timedelta(days=d.day - 1), nxt - _dt.timedelta(days=1))


def horizon_start(run_date: _dt.date) -> _dt.date:
    """B6 for one run, on the driver: the earliest order day a run charges."""
    start, _ = Wn.settlement_window_literal(run_date)
    return max(_add_months(run_date, -20), _add_months(start, -18))


def scheduled_runs(spark: SparkSession, sf_dir: str, run_date: _dt.date | None = None) -> DataFrame:
    """Every scheduled run (Mondays and 1sts from the first order day to the
    week after the last campaign end, with or without orders on the day), or the
    single ``run_date`` with its window computed on the driver."""
    if run_date is not None:
        start, end = Wn.settlement_window_literal(run_date)
        return spark.createDataFrame([(run_date, start, end)], "run_date date, window_start date, window_end date")
    d = F.col("run_date")
    w = Wn.settlement_window(d)
    orders = calendar.run_dates(spark, sf_dir).agg(F.min("run_date").alias("lo"), F.max("run_date").alias("hi"))
    ends = domain.campaigns(spark, sf_dir).agg(F.max(F.to_date("end_at_utc")).alias("last"))
    # one row on each side: the bounds of the calendar
    days = orders.join(ends, F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", F.greatest("hi", F.date_add("last", 7)))).alias("run_date"))
    return (days
            .where((F.weekday(d) == 0) | (F.dayofmonth(d) == 1))
            .select("run_date", w["start_date"].alias("window_start"), w["end_date"].alias("window_end")))


def concluded_campaigns(spark: SparkSession, sf_dir: str, run_date: _dt.date | None = None, enabled=ENABLED_ENTITIES) -> DataFrame:
    """Campaign versions of the enabled entities (A2) that ended inside each
    run's window (READY, valid), less those excluded by entity and name (C6).
    The window is exploded into its days (at most a month) so the range test
    becomes an equi join on the end day; for a single run the window bounds
    are also literal filters on the campaign table."""
    runs = scheduled_runs(spark, sf_dir, run_date)
    days = runs.select("run_date", "window_start", "window_end",
                       F.explode(Wn.date_array(F.col("window_start"), F.col("window_end"))).alias("end_day"))
    excluded = (F.col("global_entity_id") == EXCLUDED_ENTITY) & F.lower("campaign_name").rlike(EXCLUDED_NAMES)
    camp = (domain.entity_campaigns(spark, sf_dir)
            .join(F.broadcast(domain.enabled_entities(spark, enabled)), "global_entity_id", "left_semi")
            .where((F.col("state") == "READY") & (F.col("is_valid") == True) & ~excluded)  # noqa: E712
            .withColumn("end_day", F.to_date("end_at_utc")))
    if run_date is not None:
        start, end = Wn.settlement_window_literal(run_date)
        camp = camp.where(F.col("end_day").between(F.lit(start), F.lit(end)))
    return camp.join(days, "end_day").drop("end_day")


_ENTITY = ("global_entity_id", "country_code")


@domain.per_session
def root_campaigns(spark: SparkSession, sf_dir: str, run_date: _dt.date | None = None, enabled=ENABLED_ENTITIES) -> DataFrame:
    """L18 (D2, C6, D12, E4, E9): one row per run, entity and root campaign with
    root fields (root version's, else the child's), first creation and start and
    last end over the versions in the window, and the children as a sorted array.

    Reproduces N6: when the root version is not in the window, children
    with different names give several rows per root."""
    fc = concluded_campaigns(spark, sf_dir, run_date, enabled).select(
        "run_date", "window_start", "window_end", *_ENTITY, "campaign_id", "root_id", "campaign_name", "campaign_type",
        "campaign_subtype", "reason", "created_at_utc", "start_at_utc", "end_at_utc")
    child = fc.alias("c")
    root = fc.where(F.col("campaign_id") == F.col("root_id")).alias("r")
    dates = (fc.where(F.col("root_id").isNotNull())
             .groupBy("run_date", *_ENTITY, "root_id")
             .agg(F.min("created_at_utc").alias("min_created"), F.min("start_at_utc").alias("min_start"),
                  F.max("end_at_utc").alias("max_end"))).alias("d")

    def same(side, key):
        on = F.col(f"c.{key[0]}") == F.col(f"{side}.{key[1]}")
        for c in ("run_date", *_ENTITY):
            on = on & (F.col(f"c.{c}") == F.col(f"{side}.{c}"))
        return on

    j = (child.join(root, same("r", ("root_id", "campaign_id")), "left").join(dates, same("d", ("root_id", "root_id")), "left")
         .where(F.col("c.root_id").isNotNull()))

    def pick(name):
        return F.coalesce(F.col(f"r.{name}"), F.col(f"c.{name}"))
    keys = [*[F.col(f"c.{k}").alias(k) for k in ("run_date", "window_start", "window_end", *_ENTITY)],
            F.coalesce(F.col("r.campaign_id"), F.col("c.root_id")).alias("campaign_id"),
            F.coalesce(F.col("r.root_id"), F.col("c.root_id")).alias("root_id"),
            *[pick(k).alias(k) for k in ("campaign_name", "campaign_type", "campaign_subtype", "reason")],
            F.coalesce(F.col("d.min_created"), F.col("c.created_at_utc")).alias("campaign_created_at_utc"),
            F.coalesce(F.col("d.min_start"), F.col("c.start_at_utc")).alias("campaign_start_at_utc"),
            F.coalesce(F.col("d.max_end"), F.col("c.end_at_utc")).alias("campaign_end_at_utc")]
    kid = F.struct(*[F.col(f"c.{k}").alias(k) for k in ("campaign_id", "campaign_name", "campaign_type", "campaign_subtype", "reason",
                                                        "created_at_utc", "start_at_utc", "end_at_utc")])
    # small (runs x root campaigns) and read by every later v1 step
    return materialize(j.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.when(F.col("c.campaign_id") != F.col("c.root_id"), kid))).alias("child_campaigns")))


def flat_campaigns(spark: SparkSession, sf_dir: str, roots: DataFrame | None = None,
                   run_date: _dt.date | None = None, enabled=ENABLED_ENTITIES) -> DataFrame:
    """L20 first step (H2 + D18): root rows UNION DISTINCT their children
    (left unnest: a root without children adds a row of NULLs)."""
    roots = roots if roots is not None else root_campaigns(spark, sf_dir, run_date, enabled)
    head = ["run_date", "window_start", "window_end", "global_entity_id", "root_id"]
    a = roots.select(*head, "campaign_id", "campaign_type",
                     F.col("campaign_start_at_utc").alias("start_at_utc"),
                     F.col("campaign_end_at_utc").alias("end_at_utc"))
    b = (roots.select(*head, F.explode_outer("child_campaigns").alias("k"))
         .select(*head, F.col("k.campaign_id").alias("campaign_id"), F.col("k.campaign_type").alias("campaign_type"),
                 F.col("k.start_at_utc").alias("start_at_utc"), F.col("k.end_at_utc").alias("end_at_utc")))
    return a.unionByName(b).distinct()


# What a charged line, and a SKU of a statement, says of its product and supplier.
_SUPPLIER = ("supplier_id", "global_supplier_id", "supplier_name")
_PRODUCT = ("product_name", "brand_name", "category_level_one", "barcodes")
_UNITS = ("unit_price_listed_lc", "unit_discount_lc", "unit_price_paid_lc")


def _hundredths_of_cents(amount) -> Column:
    """A unit price as an exact decimal, cut after four places."""
    return (F.floor(amount * 10000).cast("decimal(18,0)") * F.lit(Decimal("0.0001"))).cast("decimal(18,4)")


def funded_lines(spark: SparkSession, sf_dir: str, enabled=ENABLED_ENTITIES,
                 excluded_warehouses: tuple[str, ...] = (), run_date: _dt.date | None = None,
                 excluded_vendors: tuple[str, ...] = ()) -> DataFrame:
    """Order lines of campaigns that the line's entity concluded in each
    run's window, inside the rolling horizon, charged by campaign type (C22),
    kept when > 0, with the product and supplier that L19 has for the line's
    (entity, warehouse, SKU, vendor) (NULLs where it has none).

    Only entities in ``enabled`` are settled (A2: an inline list joined as a
    broadcast table); warehouses in ``excluded_warehouses`` and vendors in
    ``excluded_vendors`` are left out (C4: ``NOT IN`` a list parameter — a NULL
    left side drops the line, an empty list keeps every line). With ``run_date``
    only that run is settled and its horizon start reaches the orders scan as a
    literal bound."""
    flat = flat_campaigns(spark, sf_dir, run_date=run_date, enabled=enabled).where(F.col("campaign_id").isNotNull())
    since = horizon_start(run_date) if run_date is not None else None
    lines = (domain.order_lines(spark, sf_dir, since=since)
             .where((F.col("is_successful") == True) & (F.col("quantity_sold") > 0)  # noqa: E712
                    & F.col("campaign_id").isNotNull()))
    if excluded_warehouses:
        lines = lines.where(~F.col("warehouse_id").isin(*excluded_warehouses))
    if excluded_vendors:
        lines = lines.where(~F.col("platform_vendor_id").isin(*excluded_vendors))
    # runs x campaigns is small: written, then broadcast if its files are, so
    # the order lines are not shuffled by campaign id
    j = (lines.join(checked_broadcast(materialize(flat)), ["global_entity_id", "campaign_id"])
         .where(F.to_date("end_at_utc").between(F.col("window_start"), F.col("window_end")))
         .where(Wn.rolling_horizon(F.col("order_date"), F.col("run_date"), F.col("window_start"))))
    amount = R.type_dependent_amount("campaign_type", "line_discount_lc", "funding_v1_lc", DISCOUNT_CHARGED_TYPE)
    charged = j.withColumn("supplier_funded_amount_lc", amount).where(F.col("supplier_funded_amount_lc") > 0)
    # charged lines are few beside all lines: the product join comes after the
    # test, with the vendors of an (entity, SKU) still in one row
    products = curate.settlement_products_table(spark, sf_dir).drop("chain_product_created_at", "country_code")
    offers = F.filter("offers", lambda o: (o["warehouse_id"] == F.col("warehouse_id")) & (o["platform_vendor_id"] == F.col("platform_vendor_id")))
    currencies = F.create_map(*[F.lit(x) for pair in CURRENCIES.items() for x in pair])
    unit, rate = F.col("unit_price_listed_lc"), F.col("discount_rate")
    return (charged.drop("supplier_id").join(products, ["global_entity_id", "sku"], "left").withColumn("offer", F.explode_outer(offers))
            .withColumns({c: F.col(f"offer.{c}") for c in _SUPPLIER})
            .withColumns({c: F.when(F.col("offer").isNotNull(), F.col(c)) for c in _PRODUCT})
            .select("run_date", F.to_date("end_at_utc").alias("campaign_concluded_date_utc"), *_SUPPLIER, "order_id", "order_date",
                    *_ENTITY, currencies[F.col("global_entity_id")].alias("currency_code"), "warehouse_id", "platform_vendor_id",
                    "campaign_id", "root_id", "sku", *_PRODUCT, "quantity_sold",
                    _hundredths_of_cents(unit).alias("unit_price_listed_lc"), _hundredths_of_cents(unit * rate).alias("unit_discount_lc"),
                    _hundredths_of_cents(unit * (F.lit(1.0) - rate)).alias("unit_price_paid_lc"),
                    "line_discount_lc", F.col("net_sales_lc").alias("total_amt_paid_lc"), "supplier_funded_amount_lc"))


_STATEMENT = ("run_date", *_ENTITY, "currency_code", *_SUPPLIER)


def sku_funding(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None,
                run_date: _dt.date | None = None) -> DataFrame:
    """L21 (E1–E3): per run, day the campaign concluded, entity, country,
    currency, supplier, root campaign and SKU with its product columns. Sums stay
    decimal; the averages of unit prices are unweighted, an exact sum / count in
    double."""
    lines = lines if lines is not None else funded_lines(spark, sf_dir, run_date=run_date)
    return (lines.groupBy(*_STATEMENT, "campaign_concluded_date_utc", "root_id", "sku", *_PRODUCT)
            .agg(*[(F.sum(u).cast("double") / F.count(u)).alias(f"avg_{u}") for u in _UNITS],
                 F.coalesce(F.sum("supplier_funded_amount_lc"), F.lit(0).cast(MONEY)).alias("total_funded_lc"),
                 F.sum("quantity_sold").alias("total_quantity"),
                 F.coalesce(F.sum("line_discount_lc"), F.lit(0).cast(MONEY)).alias("total_discount_lc"),
                 F.coalesce(F.sum("total_amt_paid_lc"), F.lit(0).cast(MONEY)).alias("total_amt_paid_lc"),
                 F.count(F.lit(1)).alias("n_lines")))


def supplier_statement(spark: SparkSession, sf_dir: str, run_date: _dt.date | None = None) -> DataFrame:
    """L22 (E10, I21): one row per run, entity, country, currency and supplier,
    campaigns[] with the root's fields, its child_campaigns[], and its skus[]
    with their averages and the unit funding = SAFE_DIVIDE(funded, quantity).

    A root that L18 lists several times (N6) comes with its SKUs each time."""
    per_sku = sku_funding(spark, sf_dir, run_date=run_date).withColumn(
        "unit_funding_lc", F.try_divide(F.col("total_funded_lc").cast("double"), F.col("total_quantity").cast("double")))
    skus = nest(per_sku, [*_STATEMENT, "root_id"], "skus",
                ["sku", *_PRODUCT, *[f"avg_{u}" for u in _UNITS], "total_quantity", "total_discount_lc", "total_amt_paid_lc", "total_funded_lc",
                 "unit_funding_lc", "campaign_concluded_date_utc"],
                extra_aggs=[F.sum("total_funded_lc").alias("campaign_funded_lc")])
    roots = checked_broadcast(root_campaigns(spark, sf_dir, run_date).drop("window_end", "campaign_id"))
    j = skus.join(roots, ["run_date", *_ENTITY, "root_id"])
    return nest(j, [*_STATEMENT, "window_start"], "campaigns",
                ["root_id", "campaign_name", "campaign_type", "campaign_subtype", "reason", "campaign_created_at_utc", "campaign_start_at_utc",
                 "campaign_end_at_utc", "child_campaigns", "campaign_funded_lc", "skus"]
                ).withColumnRenamed("window_start", "campaign_concluded_week_utc")


def statement_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L22 summarised per run, entity and supplier from the nested rows."""
    st = supplier_statement(spark, sf_dir)
    skus = F.flatten(F.transform("campaigns", lambda c: c["skus"]))
    return st.select(
        *_STATEMENT, "campaign_concluded_week_utc",
        F.size("campaigns").cast("bigint").alias("n_campaigns"),
        F.aggregate("campaigns", F.lit(0), lambda acc, c: acc + F.size(c["child_campaigns"])).cast("bigint").alias("n_children"),
        F.size(skus).cast("bigint").alias("n_sku_rows"),
        F.aggregate("campaigns", F.lit(0).cast("decimal(38,2)"),
                    lambda acc, c: (acc + c["campaign_funded_lc"]).cast("decimal(38,2)")).alias("total_funded_lc"),
        F.array_min(F.transform("campaigns", lambda c: c["root_id"])).alias("min_root_id"),
        F.array_max(F.transform("campaigns", lambda c: c["root_id"])).alias("max_root_id"),
        F.array_max(F.transform("campaigns", lambda c: c["campaign_name"])).alias("max_campaign_name"),
        F.array_min(F.transform("campaigns", lambda c: c["campaign_created_at_utc"])).alias("first_created_at_utc"),
        F.array_max(F.transform(skus, lambda s: s["avg_unit_price_paid_lc"])).alias("max_avg_unit_price_paid_lc"),
        F.array_max(F.transform(skus, lambda s: s["unit_funding_lc"])).alias("max_unit_funding_lc"))


def run_statement(spark: SparkSession, sf_dir: str, run_date: _dt.date, out_dir: str) -> dict[str, str]:
    """The weekly / monthly v1 job for one scheduled run: window and rolling
    horizon are computed on the driver, so they reach the scans as literal
    bounds (the reference joins a one-row CTE, which hides them from the
    planner). Writes the SKU funding and the nested statement (A6)."""
    import os
    from promofund.sources.sinks import write_clustered
    paths = {k: os.path.join(out_dir, k) for k in ("sku_funding", "supplier_statement")}
    write_clustered(sku_funding(spark, sf_dir, run_date=run_date), paths["sku_funding"],
                    ["global_entity_id", "supplier_id", "root_id", "sku"])
    write_clustered(supplier_statement(spark, sf_dir, run_date=run_date), paths["supplier_statement"],
                    ["global_entity_id", "supplier_id"])
    return paths
