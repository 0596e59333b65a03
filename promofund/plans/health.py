"""Quality and monitoring jobs (M1–M6) over the settlement outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.operators import quality as Q
from promofund.plans import clean, settle_v2
from promofund.sources import domain
from promofund.sources.tables import scan


def no_nulls_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 on the order-line view; ``created_date_utc`` is declared but absent."""
    lines = domain.order_lines(spark, sf_dir)
    return Q.no_nulls(lines, "order_lines",
                      ["order_id", "sku", "warehouse_id", "campaign_id", "funding_v1_lc", "created_date_utc"])


def duplicates_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 on three declared keys."""
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    ev = scan(spark, sf_dir, "events", ["event_id"])
    rules = settle_v2.funding_rules(spark, sf_dir)
    return Q.suite(Q.no_duplicates(li, "lineitem", ["l_orderkey", "l_linenumber"]),
                   Q.no_duplicates(ev, "events", ["event_id"]),
                   Q.no_duplicates(rules, "funding_rules", ["global_entity_id", "campaign_id", "sku"]))


def statement_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: uniqueness written as an aggregate statement, as the YAML tests do."""
    li = scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    merged = clean.two_source_merge(spark, sf_dir)
    return Q.suite(
        Q.statement_true(li, "lineitem", "unique_order_line",
                         "COUNT(DISTINCT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)) = COUNT(*)"),
        Q.statement_true(merged, "merged_events", "unique_user_props",
                         "COUNT(DISTINCT CAST(user_id AS STRING) || '|' || COALESCE(props, 'null')) = COUNT(*)"))


# The post-run alert thresholds of the settlement (T4 rows,
# funded share, v1 sum, |v2 - v1| delta in percent, T5 rows).
@dataclass(frozen=True)
class HealthThresholds:
    """M4 alert thresholds (defaults = the published post-run table)."""
    min_t4_rows: float = 100_000_000
    min_funded_share: float = 0.15
    min_v1_sum: float = 0.0
    max_abs_delta_pct: float = 50.0
    min_t5_rows: float = 1_000


def health_report(spark: SparkSession, sf_dir: str, th: HealthThresholds = HealthThresholds(),
                  t4: DataFrame | None = None, t5: DataFrame | None = None) -> DataFrame:
    """M4: one aggregate pass over T4 and one over T5 -> metric rows with
    alert status. Shares and deltas are double ops on exact sums. A scheduled
    run passes the written T4/T5 tables; otherwise they are computed."""
    t4 = t4 if t4 is not None else settle_v2.order_funding(spark, sf_dir)
    t5 = t5 if t5 is not None else settle_v2.billing_output(spark, sf_dir, t4=t4)
    a = t4.agg(F.count(F.lit(1)).alias("rows"),
               F.count_if(F.col("funding_total_lc") > 0).alias("funded"),
               F.sum("funding_amount_lc").cast("double").alias("v2"),
               F.sum("funding_v1_lc").cast("double").alias("v1"))
    m = a.select(
        F.col("rows").cast("double").alias("t4_rows"),
        (F.col("funded") / F.col("rows")).alias("funded_share"),
        F.col("v1").alias("v1_sum"),
        ((F.col("v2") - F.col("v1")) / F.col("v1") * 100.0).alias("delta_pct"))
    rows4 = m.unpivot([], ["t4_rows", "funded_share", "v1_sum", "delta_pct"], "metric", "value")
    rows5 = t5.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("t5_rows").alias("metric"), "value")
    rows = rows4.unionByName(rows5)
    thr = (F.when(F.col("metric") == "t4_rows", F.lit(th.min_t4_rows))
           .when(F.col("metric") == "funded_share", F.lit(th.min_funded_share))
           .when(F.col("metric") == "v1_sum", F.lit(th.min_v1_sum))
           .when(F.col("metric") == "delta_pct", F.lit(th.max_abs_delta_pct))
           .otherwise(F.lit(th.min_t5_rows)))
    alert = (F.when(F.col("metric") == "delta_pct", F.abs(F.col("value")) > F.col("threshold"))
             .when(F.col("metric") == "v1_sum", F.col("value") <= F.col("threshold"))
             .otherwise(F.col("value") < F.col("threshold")))
    return rows.withColumn("threshold", thr).withColumn(
        "status", F.when(alert, F.lit("alert")).otherwise(F.lit("ok")))


def coverage_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: share of order lines carrying a promo-tool campaign id per entity
    and the join strategy it suggests (>90 %: campaign_id, 50–90 %: hybrid,
    else date_warehouse_sku), next to the configured one."""
    lines = domain.order_lines(spark, sf_dir)
    cov = lines.groupBy("global_entity_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("campaign_id").isNotNull()).alias("n_with_campaign"))
    pct = F.col("n_with_campaign").cast("double") * 100.0 / F.col("n_lines")
    cfg = domain.config(spark, active_only=False).select(
        "global_entity_id", F.col("join_strategy").alias("configured_join_strategy"))
    return (cov.withColumn("coverage_pct", pct)
            .withColumn("suggested_join_strategy",
                        F.when(F.col("coverage_pct") > 90, F.lit("campaign_id"))
                        .when(F.col("coverage_pct") >= 50, F.lit("hybrid"))
                        .otherwise(F.lit("date_warehouse_sku")))
            .join(F.broadcast(cfg), "global_entity_id", "left"))


def duplicate_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 extension for N4: per v1 run, the (order, sku) pairs charged more
    than once (two lines of one SKU, or one item under two campaigns) and
    the amount those repeats add. Two partial aggregates, no collect."""
    from promofund.plans import settle_v1
    lines = settle_v1.funded_lines(spark, sf_dir)
    per_key = (lines.groupBy("run_date", "order_id", "sku")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("supplier_funded_amount_lc").alias("amount")))
    dup = per_key.where(F.col("n") > 1)
    return dup.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("n_duplicate_keys"),
        F.sum(F.col("n") - 1).cast("bigint").alias("n_extra_charges"),
        F.sum("amount").alias("duplicate_key_amount_lc"))
