"""Curated catalogue (L17: D3, D16, F3, E8, E12, C11, C25, C29; N9 and N10).

Chain products meet their dimensions before their vendor products are unnested,
which are nested again on the chain product. Two joins fan out by design, as the reference's do: the VAT rate
is joined on the catalogue id alone, so rates of all entities that sell the
product come with each vendor product (N10), and the sources are joined on the
entity alone, so a chain product comes once per source of its entity and counts
as a dark-store chain if any chain of the entity does (N9).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promofund.operators.dedup import top1
from promofund.operators.nested import nest
from promofund.plans import curate, enrich, histories
from promofund.sources import domain

# Brands that count as own ones together with a category flag, and
# the sources (entity, chain).
OWN_BRANDS = ("Brand#1", "Brand#2")
EVD_BRAND = "Brand#3"
SOURCES = (("ASIA", "c1"), ("ASIA", "c2"), ("EUROPE", "c1"))


def vendor_products(spark: SparkSession, sf_dir: str, chains: DataFrame | None = None, also: Sequence[str] = ()) -> DataFrame:
    """One row per (entity, chain product, vendor), with the columns ``also`` of
    ``chains``. Type, price buffer and the listing flag follow from SKU and branch;
    a warehouse that is missing is ''."""
    chains = chains if chains is not None else curate.chain_products(spark, sf_dir)
    rows = chains.select(
        "global_entity_id", "country_code", "sku", "product_name", "brand_name", "chain_product_created_at", *also, F.inline_outer("vendor_products"))
    branch = F.element_at(F.split("catalog_global_vendor_id", "-"), -1).cast("bigint")
    return rows.select(
        "global_entity_id", "country_code", "sku", "product_name", "brand_name", "chain_product_created_at", "catalog_global_vendor_id",
        F.coalesce("warehouse_id", F.lit("")).alias("warehouse_id"), "warehouse_name", F.coalesce("is_dmart", F.lit(False)).alias("is_dmart"),
        F.when(branch % 3 == 0, "SHOP").otherwise("DMART").alias("type"),
        F.when((F.col("sku") + branch) % 4 != 0, F.col("sku") % 5).alias("own_buffer"),
        F.when(branch % 4 == 0, True).when(branch % 4 != 1, False).alias("is_lbi_v2_enabled"),
        ((F.col("sku") + branch) % 6 == 0).alias("has_evd_category"), *also)


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(regionkey, global_entity_id): five rows at every scale."""
    from promofund.sources.tables import scan
    return F.broadcast(scan(spark, sf_dir, "region", ["r_regionkey", "r_name"]).select(F.col("r_regionkey").alias("regionkey"), F.col("r_name").alias("global_entity_id")))


def sales_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The buffer of each (entity, product) that ends last, then starts last, then
    comes from the later source. A product has buffers in two entities."""
    versions = histories.buffer_history(spark, sf_dir)
    both = versions.withColumn("src", F.explode(F.array(F.lit("a"), F.lit("b")))).withColumn(
        "sales_buffer", F.col("sales_buffer") + F.when(F.col("src") == "b", 10).otherwise(0))
    rows = both.withColumn("regionkey", F.explode(F.array(F.col("sku") % 5, (F.col("sku") + 1) % 5))).join(_entities(spark, sf_dir), "regionkey")
    return top1(rows, ["global_entity_id", "sku"], [F.col("valid_to").desc(), F.col("valid_from").desc(), F.col("src").desc()]).select(
        "global_entity_id", "sku", "sales_buffer")


def current_vat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current VAT rates of a product: one of each of two entities; every
    seventh product has none. Keyed by the product alone (N10)."""
    now = enrich.vat_history(spark, sf_dir).where((F.col("valid_to") == F.lit(enrich.OPEN_END)) & (F.col("sku") % 7 != 0))
    return now.withColumn("entity_step", F.explode(F.array(F.lit(0), F.lit(2)))).select("sku", (F.col("vat_pct") + F.col("entity_step")).alias("vat_rate"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shelf places of every second product in the warehouses that hold it."""
    held = domain.dmart_products(spark, sf_dir).where("sku % 2 = 0").select("warehouse_id", "sku").distinct()
    return held.withColumn("rack", F.concat(F.lit("R"), (F.col("sku") % 9).cast("string")))


def curated_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (entity, chain product) and source of its entity, with
    vendor_products[], the chain flag (N9) and the three-valued own-brand flag."""
    # all that hangs on the product meets the chain product, the rates and places
    # as arrays, before the vendors are unnested: vendor rows are not shuffled
    rates = current_vat(spark, sf_dir).groupBy("sku").agg(F.collect_list(F.struct("vat_rate")).alias("rates"))
    places = locations(spark, sf_dir).groupBy("sku").agg(F.collect_list(F.struct("warehouse_id", "rack")).alias("places"))  # bounded by the warehouses
    chains = (curate.chain_products(spark, sf_dir).drop("barcodes", "master_categories").join(rates, "sku", "left").join(places, "sku", "left")
              .join(sales_buffers(spark, sf_dir), ["global_entity_id", "sku"], "left"))
    here = F.filter("places", lambda p: (p["warehouse_id"] == F.col("warehouse_id")) & ~F.col("is_lbi_v2_enabled"))
    wide = (vendor_products(spark, sf_dir, chains, ["rates", "places", "sales_buffer"]).withColumn("rack", F.get(here, F.lit(0))["rack"]).drop("places")
            .withColumn("rate", F.explode_outer("rates")).withColumn("vat_rate", F.col("rate.vat_rate")).drop("rates", "rate"))
    wide = wide.withColumn("sales_buffer", F.when(F.col("type") == "SHOP", F.coalesce("own_buffer", "sales_buffer", F.lit(0).cast("bigint")))
                           .otherwise(F.coalesce("sales_buffer", F.lit(0).cast("bigint"))))
    keys = ["global_entity_id", "country_code", "sku", "product_name", "brand_name", "chain_product_created_at"]
    nested = nest(wide, keys, "vendor_products",
                  ["catalog_global_vendor_id", "warehouse_id", "warehouse_name", "is_dmart", "type", "sales_buffer", "vat_rate", "rack"],
                  extra_aggs=[F.bool_or("has_evd_category").alias("has_evd_category")])
    # a handful of sources; joined on the entity alone
    sources = spark.createDataFrame(list(SOURCES), "s_entity string, chain_id string")
    out = nested.join(F.broadcast(sources), F.col("global_entity_id") == F.col("s_entity"), "left")
    is_evd_brand = F.when(F.col("sku") % 3 != 0, F.col("brand_name") == EVD_BRAND)
    return out.select(*keys, "chain_id", F.col("chain_id").isNotNull().alias("is_chain_from_dmart"),
                      (is_evd_brand | (F.col("brand_name").isin(*OWN_BRANDS) & F.col("has_evd_category"))).alias("is_evd_product"), "vendor_products")


def curated_catalogue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated catalogue with its vendor products read back."""
    c = curated_catalogue(spark, sf_dir)
    vps = F.col("vendor_products")

    def total(get):
        return F.aggregate(vps, F.lit(0).cast("bigint"), lambda acc, v: acc + F.coalesce(get(v).cast("bigint"), F.lit(0).cast("bigint")))

    return c.select(
        "global_entity_id", "country_code", "sku", "product_name", "brand_name", "chain_product_created_at", "chain_id", "is_chain_from_dmart", "is_evd_product",
        F.size(vps).cast("bigint").alias("n_vendor_products"),
        F.size(F.array_distinct(F.transform(vps, lambda v: v["catalog_global_vendor_id"]))).cast("bigint").alias("n_vendors"),
        total(lambda v: v["vat_rate"]).alias("vat_sum"), total(lambda v: v["sales_buffer"]).alias("buffer_sum"),
        F.size(F.filter(vps, lambda v: v["rack"].isNotNull())).cast("bigint").alias("n_placed"),
        F.size(F.filter(vps, lambda v: v["warehouse_id"] == "")).cast("bigint").alias("n_without_warehouse"))
