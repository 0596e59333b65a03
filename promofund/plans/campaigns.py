"""Campaign cleaning and curation (L4, L5, L10, L11 shapes).

Raw promo-tool campaign rows are derived from ``part`` (one row per part and
campaign family, see ``sources.domain``) and carry the raw shapes the clean
job has to undo: a JSON discount, type aliases, audience keywords mixed with
segment ids, and a deactivation that only shows as ``updated < start``.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.functions import rules as R
from promofund.functions.scalars import json_scalar, safe_double
from promofund.operators.dedup import latest_per_key, priority_dedupe, top1, union_sources
from promofund.operators.nested import nest
from promofund.plans import clean
from promofund.sources import domain
from promofund.sources.sinks import scratch_path, stamp, write_clustered

MONEY = "decimal(18,2)"


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows: one per (part, family), with JSON discount, raw audience,
    active flag and last update time."""
    rows = domain.raw_campaign_rows(spark, sf_dir)
    b = F.when(F.col("family") == 1, F.col("p_size") % 4).otherwise(F.col("p_size") % 3)
    key = F.regexp_extract("campaign_id", r"^C\d-(.*)-\d+$", 1)
    audience = (F.when(F.col("family") == 1,
                       F.when(b == 0, F.lit("ALL")).when(b == 1, F.lit("NEW_USER")).when(b == 2, F.lit(None))
                       .otherwise(F.concat(F.lit("seg-"), key)))
                .otherwise(F.when(b == 0, F.lit("RETURNING")).otherwise(F.concat(F.lit("seg-"), key))))
    active = F.when(F.col("family") == 1, b != 3).otherwise(b != 1)
    shift = F.when(b == 3, F.lit(-10)).otherwise(F.lit(5))
    return rows.select(
        "campaign_id", "root_id", "campaign_name", F.col("raw_type").alias("type"), "applies_to",
        F.to_json(F.struct(F.col("discount_type").alias("type"), F.col("discount_value").alias("value"))).alias("discount"),
        audience.cast("string").alias("target_audience"),
        F.col("start_date").cast("timestamp_ntz").alias("start_time"),
        F.col("end_date").cast("timestamp_ntz").alias("end_time"),
        F.date_add("start_date", shift).cast("timestamp_ntz").alias("updated_date"),
        active.alias("active"), "state", "p_partkey")


def clean_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: latest row per campaign (F1), JSON parsed (I26/I24), type
    normalised and audience split (C14/C15), subtype (C13), validity (C16)."""
    raw = latest_per_key(raw_campaigns(spark, sf_dir), ["campaign_id"], "updated_date",
                         tie_break=[F.col("p_partkey").asc()])
    ctype = R.normalise_campaign_type("type")
    aud, aud_id = R.audience_split("target_audience")
    dtype = json_scalar("discount", "$.type")
    dval = safe_double(json_scalar("discount", "$.value"))
    out = raw.select(
        "campaign_id", "root_id", "campaign_name", ctype.alias("campaign_type"), "applies_to",
        dtype.alias("discount_type"), dval.alias("discount_value"),
        aud.alias("target_audience"), aud_id.alias("target_audience_id"),
        F.col("start_time").alias("start_at_utc"), F.col("end_time").alias("end_at_utc"),
        R.validity_flag("updated_date", "start_time", "active").alias("is_valid"), "state")
    return out.withColumn("campaign_subtype", R.campaign_subtype("campaign_type", "applies_to",
                                                                 "discount_type", "discount_value"))


def benefits_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 (F2 + H1 + C1): old and new benefit sources united, the new
    one (priority 1) wins per (campaign, sku). The new source re-states the
    ABSOLUTE contracts of sizes 2 and 3 with 0.50 more funding."""
    ben = domain.benefits(spark, sf_dir).select("campaign_id", "sku", "supplier_funding_type",
                                                "supplier_funding_value", "is_deleted")
    new = (ben.where(F.col("supplier_funding_type") == "ABSOLUTE")
           .where(F.col("supplier_funding_value") > 0)
           .withColumn("supplier_funding_value",
                       (F.col("supplier_funding_value") + F.lit(Decimal("0.50"))).cast(MONEY)))
    u = union_sources([(ben, "old", 2), (new, "new", 1)])
    return priority_dedupe(u, ["campaign_id", "sku"], "src_priority")


def nested_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 (E8 x 3 + D3): one row per campaign with its benefits[], triggers[]
    and vendors[], each nested before its join (pre-aggregate, then a left join
    on campaign id). Campaigns without children keep empty arrays; the grain is
    the same at every size."""
    ben = benefits_merged(spark, sf_dir)
    benefits = nest(ben.where(F.col("is_deleted") == False), ["campaign_id"], "benefits",  # noqa: E712
                    ["sku", "supplier_funding_type", "supplier_funding_value", "src"])
    triggers = nest(clean.campaign_triggers(spark, sf_dir), ["campaign_id"], "triggers", ["sku", "vendor_id"])
    vendors = nest(clean.campaign_vendors(spark, sf_dir), ["campaign_id"], "vendors", ["vendor_id", "n_skus"])
    out = clean_campaigns(spark, sf_dir)
    for name, children in (("benefits", benefits), ("triggers", triggers), ("vendors", vendors)):
        empty = F.array().cast(children.schema[name].dataType)
        out = out.join(children, "campaign_id", "left").withColumn(name, F.coalesce(F.col(name), empty))
    return out


def nested_campaign_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = nested_campaigns(spark, sf_dir)
    return n.select(
        "campaign_id", F.size("benefits").cast("bigint").alias("n_benefits"),
        F.size(F.filter("benefits", lambda b: b["src"] == "new")).cast("bigint").alias("n_new_source"),
        F.aggregate("benefits", F.lit(0).cast("decimal(38,2)"),
                    lambda acc, b: acc + F.coalesce(b["supplier_funding_value"], F.lit(0).cast(MONEY))).alias("sum_funding_value"))


# ------------------------------------------------------------------ clean tables by entity
KEY = ("country_code", "global_entity_id")


def _run_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which entity runs which campaign, since when."""
    return domain.entity_campaigns(spark, sf_dir).select(*KEY, "campaign_id", F.col("start_date").alias("runs_from"))


def _day(days: Column) -> Column:
    return F.date_add("runs_from", days.cast("int")).cast("timestamp_ntz")


def clean_campaign_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 by its own key: the row created last per (country, campaign), whatever
    was updated later, with type, audience, discount, validity and subtype.

    The promo tool has a row per product and entity; creation goes back by the
    product's key, the smaller key settles ties."""
    raw = raw_campaigns(spark, sf_dir).join(_run_by(spark, sf_dir), "campaign_id").withColumn("creation_date", _day(-(F.col("p_partkey") % 30)))
    last = top1(raw, ["country_code", "campaign_id"], [F.col("creation_date").desc_nulls_last()], [F.col("p_partkey").asc(), F.col("global_entity_id").asc()])
    aud, aud_id = R.audience_split("target_audience")
    out = last.select(
        *KEY, "campaign_id", "campaign_name", R.normalise_campaign_type("type").alias("campaign_type"), aud.alias("target_audience"),
        aud_id.alias("target_audience_id"), "applies_to", json_scalar("discount", "$.type").alias("discount_type"),
        safe_double(json_scalar("discount", "$.value")).alias("discount_value"), F.col("creation_date").alias("created_at_utc"),
        F.col("updated_date").alias("updated_at_utc"), F.col("start_time").alias("start_at_utc"), F.col("end_time").alias("end_at_utc"),
        F.col("active").alias("is_active"), "root_id", "state", R.validity_flag("updated_date", "start_time", "active").alias("is_valid"))
    return out.withColumn("campaign_subtype", R.campaign_subtype("campaign_type", "applies_to", "discount_type", "discount_value"))


def merged_benefit_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 whole (F1, H1, F2): the new source's last modified version per (country,
    entity, campaign, sku), united with the old source; the new one wins, also
    where its last version is a deletion.

    The new source restates the positive ABSOLUTE contracts up to three times, a
    day and 0.50 more each; the third deletes every fifth product's."""
    ben = domain.benefits(spark, sf_dir).join(_run_by(spark, sf_dir), "campaign_id")
    cols = [*KEY, "campaign_id", "sku", "supplier_funding_type", "supplier_funding_value", "created_at_utc", "updated_at_utc", "is_deleted"]
    old = ben.withColumns({"created_at_utc": _day(F.lit(-3)), "updated_at_utc": _day(F.lit(0))}).select(cols)
    new = (ben.where((F.col("supplier_funding_type") == "ABSOLUTE") & (F.col("supplier_funding_value") > 0))
           .withColumn("version", F.explode(F.sequence(F.lit(0), (F.col("sku") % 3).cast("int"))))
           .withColumns({"supplier_funding_value": (F.col("supplier_funding_value") + (F.col("version") + 1) * F.lit(Decimal("0.50"))).cast(MONEY),
                         "created_at_utc": _day(F.lit(0)), "updated_at_utc": _day(F.col("version")),
                         "is_deleted": (F.col("version") == 2) & (F.col("sku") % 5 == 0)}).select(cols))
    last = latest_per_key(new, [*KEY, "campaign_id", "sku"], "updated_at_utc")
    return priority_dedupe(union_sources([(old, "Old benefits", 2), (last, "New benefits", 1)]), [*KEY, "campaign_id", "sku"], "src_priority")


def clean_campaign_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 whole (F1, C26): the last updated row per (country, entity, campaign,
    vendor), rows never updated last; the update time falls back to the creation."""
    ec = domain.entity_campaigns(spark, sf_dir).select(*KEY, "campaign_id", F.col("start_date").alias("runs_from"), F.inline("vendors"))
    rows = ec.withColumn("version", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    branch = F.element_at(F.split("catalog_global_vendor_id", "-"), -1).cast("int")
    rows = rows.withColumns({"creation_date": _day(F.col("version")),
                             "updated_date": F.when((branch + F.col("version")) % 3 != 0, _day(10 - 3 * F.col("version"))).when(branch % 6 == 1, _day(F.lit(2)))})
    rows = rows.where((branch % 4 != 3) | (F.col("version") == 0))
    last = latest_per_key(rows, [*KEY, "campaign_id", "catalog_global_vendor_id"], "updated_date", tie_break=[F.col("creation_date").asc()])
    return last.select(*KEY, "campaign_id", "catalog_global_vendor_id", F.col("creation_date").alias("created_at_utc"),
                       F.coalesce("updated_date", "creation_date").alias("updated_at_utc"))


# Fixed rule (C7, C15): vendor codes of these entity families are the additional
# remote ids; '_' is a wildcard. This entity is for tests and left out.
REMOTE_FAMILIES = ("AS_A", "EU%", "M_D%")
TEST_ENTITY = "AFRICA"


def clean_vendor_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8 whole (F1, C5, C7, C15): the last synchronised row per (country,
    entity, vendor) with its soft-delete time, the code in one of two columns by
    entity family. Vendors are the suppliers; every second one was synchronised
    again, and by then every ninth one was deleted."""
    from promofund.sources.tables import scan
    sup = scan(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    nation = domain.vendors(spark, sf_dir).select("nationkey", *KEY).distinct()  # 25 rows
    v = sup.join(F.broadcast(nation), F.col("s_nationkey") == F.col("nationkey")).where(F.col("global_entity_id") != TEST_ENTITY)
    v = v.withColumn("version", F.explode(F.sequence(F.lit(0), (1 - F.col("s_suppkey") % 2).cast("int"))))
    day = (F.col("s_suppkey") % 50).cast("int")
    at = lambda n: F.date_add(F.lit("2020-01-01").cast("date"), n).cast("timestamp_ntz")
    v = v.withColumns({"created_at_utc": at(day - 100), "updated_at_utc": at(day + F.col("version")),
                       "deleted_at_utc": F.when((F.col("version") == 1) & (F.col("s_suppkey") % 9 == 0), at(day + 1)),
                       "synchronized_at_utc": at(day + 2 * F.col("version")), "vendor_id": F.col("s_suppkey"),
                       "vendor_code": F.concat(F.lit("C"), F.col("s_suppkey").cast("string"), F.lit("-"), F.col("version").cast("string"))})
    last = latest_per_key(v, [*KEY, "vendor_id"], "synchronized_at_utc", tie_break=[F.col("version").desc()])
    remote = F.lit(False)
    for family in REMOTE_FAMILIES:
        remote = remote | F.col("global_entity_id").like(family)
    return last.select(*KEY, F.col("vendor_id").alias("catalog_global_vendor_id"), F.when(~remote, F.col("vendor_code")).alias("catalog_remote_vendor_id"),
                       F.when(remote, F.col("vendor_code")).alias("catalog_additional_remote_vendor_id"), F.col("s_name").alias("name"),
                       "created_at_utc", "updated_at_utc", "deleted_at_utc", "synchronized_at_utc")


# ------------------------------------------------------------------ curated campaigns
def merged_trigger_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L13 (F1, H1, F2): the new triggers' last version per (country, entity,
    campaign, sku) over the old ones, whose missing SKU is the product's id.

    The new source restates every fourth product; every eighth once more, a day
    later, as deleted."""
    runs = _run_by(spark, sf_dir)
    cols = [*KEY, "campaign_id", "sku", "created_at_utc", "updated_at_utc", "is_deleted"]
    old = latest_per_key(clean.raw_triggers(spark, sf_dir), ["campaign_id", "product_id"], "modified_at", tie_break=[F.col("vendor_id").asc()])
    old = old.withColumns({"sku": F.coalesce("sku", "product_id"), "created_at_utc": F.col("modified_at"), "updated_at_utc": F.col("modified_at"),
                           "is_deleted": F.lit(False)}).join(runs, "campaign_id").select(cols)
    new = domain.benefits(spark, sf_dir).where("sku % 4 = 0").select("campaign_id", "sku").join(runs, "campaign_id")
    new = (new.withColumn("version", F.explode(F.sequence(F.lit(0), F.when(F.col("sku") % 8 == 0, 1).otherwise(0))))
           .withColumns({"created_at_utc": _day(F.lit(0)), "updated_at_utc": _day(F.col("version")), "is_deleted": F.col("version") == 1}).select(cols))
    last = latest_per_key(new, [*KEY, "campaign_id", "sku"], "updated_at_utc")
    return priority_dedupe(union_sources([(old, "Old triggers", 2), (last, "New triggers", 1)]), [*KEY, "campaign_id", "sku"], "src_priority")


def nested_campaign_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L10 whole (E8 x 3, D3): the clean campaigns with benefits[], triggers[] and
    vendors[] of their country, each with its times and source. Every array is
    nested before its join; campaigns without children keep empty arrays."""
    key = ["country_code", "campaign_id"]
    history = ["created_at_utc", "updated_at_utc"]
    source = [*history, "is_deleted", "src", "src_priority"]
    out = clean_campaign_versions(spark, sf_dir)
    for name, rows, fields in (
            ("benefits", merged_benefit_versions(spark, sf_dir), ["sku", "supplier_funding_type", "supplier_funding_value", *source]),
            ("triggers", merged_trigger_versions(spark, sf_dir), ["sku", *source]),
            ("vendors", clean_campaign_vendors(spark, sf_dir), ["catalog_global_vendor_id", *history])):
        children = nest(rows, key, name, fields)
        empty = F.array().cast(children.schema[name].dataType)
        out = out.join(children, key, "left").withColumn(name, F.coalesce(F.col(name), empty))
    return out


def curated_campaigns(spark: SparkSession, sf_dir: str, as_of: _dt.datetime = _dt.datetime(2025, 1, 1), path: str | None = None) -> DataFrame:
    """L11 (A6, A9, A11, G2): the nested campaigns written as the curated table,
    clustered by country and stamped, and read back by the columns that consumers
    may see, for the entities that the config enables."""
    path = path or scratch_path(spark, "curated-campaigns")
    write_clustered(stamp(nested_campaign_versions(spark, sf_dir), as_of), path, ["country_code"])
    enabled = domain.config(spark).select("global_entity_id")
    return spark.read.parquet(path).drop("target_audience_id").join(F.broadcast(enabled), "global_entity_id", "left_semi")


def curated_campaign_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated campaigns with their arrays read back in order."""
    c = curated_campaigns(spark, sf_dir)

    def listed(array, *parts):
        return F.array_join(F.transform(array, lambda x: F.concat_ws(":", *[F.coalesce(p(x).cast("string"), F.lit("-")) for p in parts])), ",")

    live = F.filter("benefits", lambda b: ~b["is_deleted"])
    return c.select(
        "country_code", "global_entity_id", "campaign_id", "campaign_type", "campaign_subtype", "state", "is_valid", "created_at_utc", "ingested_at",
        listed("benefits", lambda b: b["sku"], lambda b: F.left(b["src"], F.lit(3)), lambda b: b["is_deleted"]).alias("benefit_list"),
        F.aggregate(live, F.lit(0).cast("decimal(38,2)"), lambda acc, b: (acc + F.coalesce(b["supplier_funding_value"], F.lit(0).cast(MONEY)))
                    .cast("decimal(38,2)")).alias("live_funding_value"),
        F.array_max(F.transform("benefits", lambda b: b["updated_at_utc"])).alias("benefits_updated_at"),
        listed("triggers", lambda t: t["sku"], lambda t: F.left(t["src"], F.lit(3)), lambda t: t["is_deleted"]).alias("trigger_list"),
        listed("vendors", lambda v: v["catalog_global_vendor_id"]).alias("vendor_list"),
        F.array_max(F.transform("vendors", lambda v: v["updated_at_utc"])).alias("vendors_updated_at"))
