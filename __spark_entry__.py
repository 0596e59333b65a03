"""

Each registered query reads the input tables under ``sf_dir`` and returns a
DataFrame whose column names and value types match its DuckDB twin in
``oracle_queries.py`` (dates as 'YYYY-MM-DD' strings, money as DOUBLE,
integers as BIGINT, timestamps as epoch microseconds).
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from promofund import session as _session  # noqa: E402
from promofund.plans import settle_v2  # noqa: E402
from promofund.plans import enrich  # noqa: E402
from promofund.streaming import lookback  # noqa: E402
from promofund.plans import campaigns  # noqa: E402
from promofund.plans import catalogue  # noqa: E402
from promofund.plans import health  # noqa: E402
from promofund.plans import histories  # noqa: E402
from promofund.plans import settle_v1  # noqa: E402
from promofund.plans import curate  # noqa: E402
from promofund.plans import clean  # noqa: E402
from promofund.plans import calendar  # noqa: E402

# The training-data operators are optional: without their folder (and
# corpus_pipeline.py) the rest works alone.
try:
    from promofund.llm import queries as _llm  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("promofund.llm", "corpus_pipeline"):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"


def normalise(df: DataFrame) -> DataFrame:
    """Cast output columns to the shared comparison types."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.DecimalType) or isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.TimestampNTZType):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(t, T.TimestampType):
            c = F.unix_micros(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _prep(spark: SparkSession) -> None:
    for k, v in _session.SESSION_DEFAULTS.items():
        if k != "spark.sql.execution.arrow.pyspark.enabled":
            spark.conf.set(k, v)


def _q(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prep(spark)
        return normalise(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# ----------------------------------------------------------------- settlement v2
def q_order_funding(spark, sf_dir):
    """L27 T4 via the bucketed interval join."""
    return settle_v2.order_funding(spark, sf_dir).drop("param_billing_period")


def q_order_funding_grid(spark, sf_dir):
    """L27 T4 via the T3 day grid (equi join on entity, day, warehouse, sku)."""
    return settle_v2.order_funding(spark, sf_dir, use_grid=True).drop("param_billing_period")


def q_billing_output(spark, sf_dir):
    """L28 T5 monthly billing."""
    return settle_v2.billing_output(spark, sf_dir)


def q_campaigns_in_use(spark, sf_dir):
    """L24 T1."""
    return settle_v2.campaigns_in_use(spark, sf_dir).select(
        "global_entity_id", "country_code", "campaign_id", "root_id", "campaign_name", "campaign_type", "campaign_subtype",
        "discount_type", "discount_value", "start_at_utc", "end_at_utc", "state", "is_valid", "trigger_qty_threshold",
        "benefit_qty_limit", F.size("vendors").cast("bigint").alias("n_vendors"))


def q_rules_contract_status(spark, sf_dir):
    """L25 T2 (C17-C19)."""
    return settle_v2.funding_rules(spark, sf_dir)


def q_daily_grid(spark, sf_dir):
    """L26 T3 day grid, summarised per entity, campaign, warehouse and month."""
    return settle_v2.daily_grid_summary(spark, sf_dir)

# ----------------------------------------------------------------- calendar
def q_settlement_window(spark, sf_dir):
    """B1-B3 for every distinct order date as a run date."""
    return calendar.settlement_windows(spark, sf_dir)


def q_window_partitions(spark, sf_dir):
    """Partitions each run refreshes."""
    return calendar.window_partitions(spark, sf_dir)


def q_load_mode_filter(spark, sf_dir):
    """Padded incremental windows and the orders they reprocess."""
    return calendar.load_mode_windows(spark, sf_dir)


def q_rolling_horizon(spark, sf_dir):
    """Rolling 20/18-month horizon flag per order."""
    return calendar.rolling_horizon_flags(spark, sf_dir)


def q_billing_month(spark, sf_dir):
    """Configurable billing month per order."""
    return calendar.billing_months(spark, sf_dir)

# ----------------------------------------------------------------- clean layer
def q_latest_per_key(spark, sf_dir):
    """newest event per (user, type)."""
    return clean.latest_events(spark, sf_dir)


def q_priority_dedupe(spark, sf_dir):
    """F2/H1: source-priority dedupe across two generations."""
    return clean.priority_merge(spark, sf_dir)


def q_two_source_merge(spark, sf_dir):
    """Newest version across sources + payload join-back."""
    return clean.two_source_merge(spark, sf_dir)


def q_json_scalar(spark, sf_dir):
    """JSON scalar extraction."""
    return clean.json_fields(spark, sf_dir)


def q_validity_from_lag(spark, sf_dir):
    """valid_to by LEAD, N7 LAG-over-DESC quirk."""
    return clean.validity_history(spark, sf_dir)


def q_multi_key_dedupe(spark, sf_dir):
    """multi-key ordering with NULLS LAST and a total-order tie-break."""
    return clean.latest_line_versions(spark, sf_dir)

# ----------------------------------------------------------------- curated layer
def q_interval_join_closed(spark, sf_dir):
    """Closed validity-interval join (price at order date)."""
    return curate.price_at_order(spark, sf_dir, closed=True)


def q_interval_join_halfopen(spark, sf_dir):
    """Half-open validity-interval join."""
    return curate.price_at_order(spark, sf_dir, closed=False)


def q_fallback_join(spark, sf_dir):
    """Second-chance join + NULL-safe key join."""
    return curate.cost_with_fallback(spark, sf_dir)


def q_anti_join_remap(spark, sf_dir):
    """Distribution-centre offers re-mapped to stores."""
    return curate.supplier_warehouses(spark, sf_dir)


def q_preferred_supplier(spark, sf_dir):
    """Preferred supplier per sku x warehouse."""
    return curate.preferred_suppliers(spark, sf_dir)


def q_nest_orders(spark, sf_dir):
    """Orders with nested items (flattened summary)."""
    return curate.nested_order_summary(spark, sf_dir)


def q_nest_unnest_roundtrip(spark, sf_dir):
    """Nest then left-unnest with positions."""
    return curate.unnested_orders(spark, sf_dir)


def q_distinct_join_string(spark, sf_dir):
    """Distinct sorted codes, LOGICAL_OR, ANY_VALUE(bool)."""
    return curate.order_flag_strings(spark, sf_dir)

# ----------------------------------------------------------------- settlement v1
def q_root_child_campaigns(spark, sf_dir):
    """L18 (D12/E4/E9): root campaigns with children per scheduled run."""
    r = settle_v1.root_campaigns(spark, sf_dir)
    return r.select("run_date", "window_start", "window_end", "global_entity_id", "country_code", "campaign_id", "root_id", "campaign_name",
                    "campaign_type", "campaign_subtype", "reason", "campaign_created_at_utc", "campaign_start_at_utc", "campaign_end_at_utc",
                    F.size("child_campaigns").cast("bigint").alias("n_children"),
                    F.array_join(F.transform("child_campaigns", lambda c: c["campaign_id"]), ",").alias("child_ids"))


def q_flatten_union_distinct(spark, sf_dir):
    """L20 step 1 (H2/D18): root UNION DISTINCT children."""
    return settle_v1.flat_campaigns(spark, sf_dir)


def q_v1_funded_lines(spark, sf_dir):
    """Charged order lines per run (B6 horizon, C22 amount)."""
    return settle_v1.funded_lines(spark, sf_dir)


def q_sku_funding(spark, sf_dir):
    """SKU funding per run, supplier, root campaign."""
    return settle_v1.sku_funding(spark, sf_dir)


def q_two_level_statement(spark, sf_dir):
    """L22 (E10/I21): nested supplier statement, flattened."""
    return settle_v1.statement_summary(spark, sf_dir)

# ----------------------------------------------------------------- quality and monitoring
def q_quality_no_nulls(spark, sf_dir):
    """M1 (+N16 column_missing)."""
    return health.no_nulls_report(spark, sf_dir)


def q_quality_no_duplicates(spark, sf_dir):
    """M2 on three declared keys."""
    return health.duplicates_report(spark, sf_dir)


def q_quality_statement(spark, sf_dir):
    """M3 aggregate statements."""
    return health.statement_report(spark, sf_dir)


def q_health_report(spark, sf_dir):
    """M4 run health metrics vs alert thresholds."""
    return health.health_report(spark, sf_dir)


def q_coverage_strategy(spark, sf_dir):
    """M6 campaign-id coverage -> suggested join strategy."""
    return health.coverage_strategy(spark, sf_dir)

# ----------------------------------------------------------------- campaigns and enrichment
def q_campaign_subtype(spark, sf_dir):
    """L4: clean campaigns (C13 subtype, C14 type, C16 validity, I26 JSON)."""
    return campaigns.clean_campaigns(spark, sf_dir).select(
        "campaign_id", "root_id", "campaign_name", "campaign_type", "campaign_subtype", "applies_to",
        "discount_type", "discount_value", "start_at_utc", "end_at_utc", "is_valid", "state")


def q_clean_campaign_versions(spark, sf_dir):
    """L4: the last created row per (country, campaign)."""
    return campaigns.clean_campaign_versions(spark, sf_dir)


def q_merged_benefit_versions(spark, sf_dir):
    """Last version of the new benefits over the old ones."""
    return campaigns.merged_benefit_versions(spark, sf_dir)


def q_clean_campaign_vendors(spark, sf_dir):
    """The last updated row per campaign and vendor."""
    return campaigns.clean_campaign_vendors(spark, sf_dir)


def q_clean_vendor_versions(spark, sf_dir):
    """The last synchronised row per vendor."""
    return campaigns.clean_vendor_versions(spark, sf_dir)


def q_merged_trigger_versions(spark, sf_dir):
    """Last version of the new triggers over the old ones."""
    return campaigns.merged_trigger_versions(spark, sf_dir)


def q_curated_campaigns(spark, sf_dir):
    """L10/L11 (A6, A9, A11, E8 x 3): curated campaigns, their arrays listed."""
    return campaigns.curated_campaign_summary(spark, sf_dir)


def q_audience_split(spark, sf_dir):
    """Audience keyword vs segment id split."""
    return campaigns.clean_campaigns(spark, sf_dir).select(
        "campaign_id", "target_audience", "target_audience_id", "is_valid")


def q_benefits_priority(spark, sf_dir):
    """Old + new benefit sources, new wins."""
    return campaigns.benefits_merged(spark, sf_dir)


def q_nested_campaigns(spark, sf_dir):
    """Campaigns with nested benefits (flattened summary)."""
    return campaigns.nested_campaign_summary(spark, sf_dir)


def q_entity_regex_exclusion(spark, sf_dir):
    """Entity-scoped regex exclusion."""
    return curate.regex_exclusion(spark, sf_dir)


def q_order_value_breakdown(spark, sf_dir):
    """Order-line money derivations."""
    return curate.order_value_breakdown(spark, sf_dir)


def q_order_line_histories(spark, sf_dir):
    """L15 (C24/C26/C27, D6, F4): eight product histories in one sweep."""
    return histories.order_line_histories(spark, sf_dir)


def q_latest_row_per_day(spark, sf_dir):
    """the latest whole row per (user, DATE(ts))."""
    return histories.latest_event_of_day(spark, sf_dir)


def q_product_texts(spark, sf_dir):
    """Text, array and time functions."""
    return clean.product_texts(spark, sf_dir)


def q_line_campaign_info(spark, sf_dir):
    """L14 nested: campaign_info[] per (order, sku)."""
    return curate.line_campaign_info_summary(spark, sf_dir)


def q_order_campaign_merge(spark, sf_dir):
    """L3 (H1, F1, D15, N17): two generations of order campaigns merged."""
    return clean.order_campaign_merge(spark, sf_dir)


def q_order_item_merge(spark, sf_dir):
    """L2: two generations of order items merged."""
    return clean.order_item_merge(spark, sf_dir)


def q_curated_catalogue(spark, sf_dir):
    """L17 (D16, C11, C25, E8, E12; N9, N10): the curated catalogue, summarised."""
    return catalogue.curated_catalogue_summary(spark, sf_dir)


def q_settlement_products(spark, sf_dir):
    """L19 (D19, E11, D11): products with barcodes, category, supplier and account."""
    return curate.settlement_products(spark, sf_dir)


def q_curated_order_items(spark, sf_dir):
    """Orders, items[] and campaign_info[] with value structs, from one scan of the lines."""
    return curate.nested_order_items_summary(spark, sf_dir)


def q_local_day_funding(spark, sf_dir):
    """Orders whose local day differs from the UTC day, funded by either."""
    return settle_v2.local_day_funding(spark, sf_dir)


def q_line_campaign_rollup(spark, sf_dir):
    """L14 (+L9/A5): line x campaign fan-out, external override, roll-up."""
    return curate.line_campaign_rollup(spark, sf_dir)


def q_shared_view(spark, sf_dir):
    """Allow-listed, entity-filtered shared view."""
    return curate.shared_view(spark, sf_dir)

# ----------------------------------------------------------------- refresh and streaming
def q_incremental_equals_full(spark, sf_dir):
    """Chunked back-fill + look-back refresh, read back (equals the full build)."""
    return spark.read.parquet(lookback.incremental_refresh(spark, sf_dir)).select(
        "order_id", "order_date", "order_month", "global_entity_id", "warehouse_id", "o_totalprice")


def q_two_speed_refresh(spark, sf_dir):
    """A full build in 2000, then refreshes of the last 180 days until all
    orders are in, read with the mandatory bounds (equals the full build)."""
    runs = [dt.datetime(2000, 10, 20, 0), dt.datetime(2001, 3, 1, 4), dt.datetime(2001, 6, 15, 8), dt.datetime(2001, 11, 1, 4)]
    table = lookback.two_speed_headers(spark, sf_dir, runs)
    return table.read(dt.date(1990, 1, 1), dt.date(2010, 1, 1)).select(
        "order_id", "order_date", "order_month", "global_entity_id", "warehouse_id", "o_totalprice")


def q_stream_latest_per_key(spark, sf_dir):
    """Structured Streaming look-back: newest event per (user, type)."""
    table = lookback.latest_stream(spark, os.path.join(sf_dir, "events.parquet"), ["user_id", "event_type"], "ts",
                                   tie_break=["event_id"])
    return table.read(0, lookback.MERGE_BUCKETS).select("event_id", "ts", "user_id", "event_type", "value", "props")

# ----------------------------------------------------------------- vendors, triggers, combo rows
def q_clean_vendors(spark, sf_dir):
    """C7 LIKE with '_' wildcard, C15 split, C11 three-valued flag."""
    return clean.clean_vendors(spark, sf_dir)


def q_campaign_triggers(spark, sf_dir):
    """Latest trigger version, COALESCE key repair, DISTINCT."""
    return clean.campaign_triggers(spark, sf_dir)


def q_campaign_vendors(spark, sf_dir):
    """Campaign x vendor."""
    return clean.campaign_vendors(spark, sf_dir)


def q_order_campaign_combo(spark, sf_dir):
    """L3: combo-product rows with a parent key."""
    return clean.order_campaign_rows(spark, sf_dir)


def q_old_benefits(spark, sf_dir):
    """created_at NULL -> updated_at, newest per key."""
    return clean.old_benefits(spark, sf_dir)

# ----------------------------------------------------------------- curated orders and catalogue
def q_curated_orders(spark, sf_dir):
    """Curated orders (D3 chain, C23 cut-over gate, FX)."""
    return curate.curated_orders(spark, sf_dir)


def q_nested_catalogue(spark, sf_dir):
    """Three-deep nested catalogue (D16, E12, C11, C25), summarised."""
    return curate.catalogue_summary(spark, sf_dir)

# ----------------------------------------------------------------- order-line enrichment
def q_order_line_enrichment(spark, sf_dir):
    """VAT (F6+D6), warehouse migrations (F7 quirk + D5), FX on a computed key."""
    return enrich.order_line_enrichment(spark, sf_dir)

def q_unnest_two_levels(spark, sf_dir):
    """E8 x2 + D18 x2: orders -> items[] -> campaign_info[], left-unnested with positions."""
    return curate.unnest_two_levels(spark, sf_dir)

def q_duplicate_charge_check(spark, sf_dir):
    """v1 (order, sku) pairs charged more than once, per run."""
    return health.duplicate_charges(spark, sf_dir)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "campaigns_in_use": q_campaigns_in_use,
    "rules_contract_status": q_rules_contract_status,
    "daily_grid": q_daily_grid,
    "order_funding": q_order_funding,
    "order_funding_grid": q_order_funding_grid,
    "billing_output": q_billing_output,
    "duplicate_charge_check": q_duplicate_charge_check,
    "unnest_two_levels": q_unnest_two_levels,
    "order_line_enrichment": q_order_line_enrichment,
    "curated_orders": q_curated_orders,
    "nested_catalogue": q_nested_catalogue,
    "clean_vendors": q_clean_vendors,
    "campaign_triggers": q_campaign_triggers,
    "campaign_vendors": q_campaign_vendors,
    "order_campaign_combo": q_order_campaign_combo,
    "old_benefits": q_old_benefits,
    "incremental_equals_full": q_incremental_equals_full,
    "two_speed_refresh": q_two_speed_refresh,
    "stream_latest_per_key": q_stream_latest_per_key,
    "campaign_subtype": q_campaign_subtype,
    "clean_campaign_versions": q_clean_campaign_versions,
    "merged_benefit_versions": q_merged_benefit_versions,
    "clean_campaign_vendors": q_clean_campaign_vendors,
    "clean_vendor_versions": q_clean_vendor_versions,
    "merged_trigger_versions": q_merged_trigger_versions,
    "curated_campaigns": q_curated_campaigns,
    "audience_split": q_audience_split,
    "benefits_priority": q_benefits_priority,
    "nested_campaigns": q_nested_campaigns,
    "entity_regex_exclusion": q_entity_regex_exclusion,
    "order_value_breakdown": q_order_value_breakdown,
    "order_line_histories": q_order_line_histories,
    "latest_row_per_day": q_latest_row_per_day,
    "product_texts": q_product_texts,
    "line_campaign_info": q_line_campaign_info,
    "order_campaign_merge": q_order_campaign_merge,
    "order_item_merge": q_order_item_merge,
    "curated_catalogue": q_curated_catalogue,
    "settlement_products": q_settlement_products,
    "curated_order_items": q_curated_order_items,
    "local_day_funding": q_local_day_funding,
    "line_campaign_rollup": q_line_campaign_rollup,
    "shared_view": q_shared_view,
    "quality_no_nulls": q_quality_no_nulls,
    "quality_no_duplicates": q_quality_no_duplicates,
    "quality_statement": q_quality_statement,
    "health_report": q_health_report,
    "coverage_strategy": q_coverage_strategy,
    "root_child_campaigns": q_root_child_campaigns,
    "flatten_union_distinct": q_flatten_union_distinct,
    "v1_funded_lines": q_v1_funded_lines,
    "sku_funding": q_sku_funding,
    "two_level_statement": q_two_level_statement,
    "interval_join_closed": q_interval_join_closed,
    "interval_join_halfopen": q_interval_join_halfopen,
    "fallback_join": q_fallback_join,
    "anti_join_remap": q_anti_join_remap,
    "preferred_supplier": q_preferred_supplier,
    "nest_orders": q_nest_orders,
    "nest_unnest_roundtrip": q_nest_unnest_roundtrip,
    "distinct_join_string": q_distinct_join_string,
    "latest_per_key": q_latest_per_key,
    "priority_dedupe": q_priority_dedupe,
    "two_source_merge": q_two_source_merge,
    "json_scalar": q_json_scalar,
    "validity_from_lag": q_validity_from_lag,
    "multi_key_dedupe": q_multi_key_dedupe,
    "settlement_window": q_settlement_window,
    "window_partitions": q_window_partitions,
    "load_mode_filter": q_load_mode_filter,
    "rolling_horizon": q_rolling_horizon,
    "billing_month": q_billing_month,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: T5 billing (T1 -> T2 -> T4 -> T5) on sf0.001."""
    return queries()["billing_output"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _q(v) for k, v in _QUERIES.items()} | (_llm.QUERIES if _llm else {})


def oracle_sql() -> dict[str, str]:
    sql = oracle_queries.oracle_sql()
    return {k: sql[k] for k in _QUERIES if k in sql} | (_llm.ORACLE_SQL if _llm else {})
