"""Two-generation merges, settlement products, nested orders, local days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from promofund.operators.dedup import merge_versions
from promofund.plans import clean, curate, settle_v2
from promofund.sources import domain


def _merge_brute(sources, keys, payload):
    """UNION ALL of keys, newest per key (NULLs group), LEFT JOIN back on key and time."""
    groups = {}
    for _, rows in sources:
        for r in rows:
            groups.setdefault(tuple(r[k] for k in keys), []).append(r["ts"])
    out = []
    for key, times in groups.items():
        known = [t for t in times if t is not None]
        ts = max(known) if known else None
        sides = []
        for name, rows in sources:
            hit = [dict(r, src=name) for r in rows if ts is not None and None not in key and tuple(r[k] for k in keys) == key and r["ts"] == ts]
            sides.append(hit or [{}])
        for a in sides[0]:
            for b in sides[1]:
                out.append((*key, ts, *[a.get(c) if a.get(c) is not None else b.get(c) for c in [*payload, "src"]]))
    return out


def test_merge_versions_equals_the_join_back(spark):
    rnd = random.Random(2)
    schema = "a int, b string, ts timestamp, x int, y string"

    def rows(n):
        return [{"a": rnd.choice([1, 2, None]), "b": rnd.choice(["p", "q", None]), "ts": rnd.choice([None, *[dt.datetime(2024, 1, d) for d in (1, 2, 3)]]),
                 "x": rnd.choice([None, rnd.randrange(99)]), "y": rnd.choice([None, "u", "v"])} for _ in range(n)]

    old, new = rows(30), rows(25)
    for r in new:
        del r["y"]  # a source may lack a payload column
    frames = [("old", spark.createDataFrame([tuple(r.values()) for r in old], schema)),
              ("new", spark.createDataFrame([tuple(r.values()) for r in new], "a int, b string, ts timestamp, x int"))]
    got = merge_versions(frames, ["a", "b"], "ts", ["x", "y"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    want = _merge_brute([("old", old), ("new", new)], ["a", "b"], ["x", "y"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_missing_product_loses_its_payload(spark):
    rows = clean.order_campaign_merge(spark, SF_SMALL)
    lost = rows.where("product_id is null")
    assert lost.count() > 0 and lost.where("src is not null or discount_lc is not null or global_entity_id is not null").count() == 0
    kept = rows.where("product_id is not null")
    assert kept.where("src is null").count() == 0
    assert {r.src for r in kept.select("src").distinct().collect()} == {"cart", "app"}


def test_array_subquery_filters_by_an_outer_column(spark):
    df = spark.createDataFrame([("as", [("b", "as"), ("a", None), ("b", "as"), ("c", "eu")]), ("eu", []), (None, [("z", "eu"), ("a", None)]), ("x", None)],
                               "country string, codes array<struct<code:string,country_code:string>>")
    got = [r.t for r in df.select(curate.array_subquery("codes", "code", lambda b: b["country_code"].isNull() | (b["country_code"] == F.col("country"))).alias("t")).collect()]
    assert got == ["a,b", "", "a", None]


def test_settlement_products_have_one_row_per_key(spark):
    rows = curate.settlement_products(spark, SF_SMALL)
    keys = ["global_entity_id", "sku", "warehouse_id", "platform_vendor_id"]
    assert rows.count() == rows.select(keys).distinct().count() > 0
    seen = rows.agg(*[F.count_if(c).alias(n) for n, c in {
        "new": F.col("product_name").endswith(" new"), "no_category": F.col("category_level_one").isNull(), "account": F.col("global_supplier_id").isNotNull(),
        "no_account": F.col("supplier_id").isNotNull() & F.col("global_supplier_id").isNull(), "no_supplier": F.col("supplier_id").isNull()}.items()]).first()
    assert all(seen), seen


def test_nested_orders_scan_the_lines_once(spark):
    n = curate.nested_order_items(spark, SF_SMALL)
    plan = n._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_orderkey#") and sum("FileScan" in x and "l_extendedprice" in x for x in plan.split("\n")) == 1
    row = n.where("size(items) > 2 and order_has_campaigns").first()
    assert [i.l_linenumber for i in row["items"]] == sorted(i.l_linenumber for i in row["items"])
    assert sum(i.value_lc.paid_lc for i in row["items"]) == row.order_value_lc.paid_lc
    assert sum(i.value_euro.funded_euro for i in row["items"]) == row.order_value_euro.funded_euro
    assert any(i.campaign_info for i in row["items"])
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert n.select(F.sum(F.size("items"))).first()[0] == lines


def test_local_days_change_the_funding(spark):
    rows = settle_v2.local_day_funding(spark, SF_MID).collect()
    assert rows and all(r.order_date_utc is None or r.order_date_lt is None or abs((r.order_date_utc - r.order_date_lt).days) == 1 for r in rows)
    assert any(r.campaign_by_utc_day != r.campaign_by_local_day for r in rows)
    utc = {(r.order_id, r.sku): r.funding_amount_lc for r in settle_v2.order_funding(spark, SF_MID).collect()}
    assert all(utc[r.order_id, r.sku] == r.amount_by_utc_day for r in rows if r.order_date_utc is not None)


def test_zones_know_daylight_saving(spark):
    from promofund.functions.windows import local_date
    df = spark.createDataFrame([("1998-06-30 22:30:00", "Europe/Berlin"), ("1998-01-30 22:30:00", "Europe/Berlin"), ("1998-01-30 23:30:00", "Europe/Berlin"),
                                ("1998-07-01 03:59:00", "America/New_York"), ("1998-01-01 04:30:00", "America/New_York")], "t string, z string")
    got = [str(r.d) for r in df.select(local_date(F.col("t").cast("timestamp"), F.col("z")).alias("d")).collect()]
    assert got == ["1998-07-01", "1998-01-30", "1998-01-31", "1998-06-30", "1997-12-31"]


def test_closed_vendors_resolve_to_no_warehouse(spark):
    bridge = {(r.global_entity_id, r.catalog_global_vendor_id): r.warehouse_id for r in settle_v2.vendor_warehouses(spark, SF_SMALL).collect()}
    for v in domain.vendors(spark, SF_SMALL).collect():
        if v.warehouse_id in (None, "") or not v.is_dmart:
            assert (v.global_entity_id, v.catalog_global_vendor_id) not in bridge
    assert bridge and all(w for w in bridge.values())


def test_catalogue_fans_out_by_design(spark):
    """A chain product comes once per source of its entity. N10: a vendor
    product comes once per VAT rate of its product, whatever the entity."""
    from promofund.plans import catalogue
    rows = catalogue.curated_catalogue(spark, SF_SMALL).collect()
    times = {}
    for r in rows:
        times.setdefault((r.global_entity_id, r.sku, r.product_name), []).append(r.chain_id)
    want = {"ASIA": ["c1", "c2"], "EUROPE": ["c1"]}
    assert all(sorted(x, key=str) == want.get(k[0], [None]) for k, x in times.items())
    assert all(r.is_chain_from_dmart == (r.global_entity_id in want) for r in rows)
    plain = catalogue.vendor_products(spark, SF_SMALL).groupBy("global_entity_id", "sku", "product_name").count().collect()
    n = {(r.global_entity_id, r.sku, r.product_name): r["count"] for r in plain}
    assert all(len(r.vendor_products) == n[r.global_entity_id, r.sku, r.product_name] * (1 if r.sku % 7 == 0 else 2) for r in rows)
    assert {r.is_evd_product for r in rows} == {True, False, None}
    placed = [v for r in rows for v in r.vendor_products if v.rack is not None]
    assert placed and all(int(v.catalog_global_vendor_id.split("-")[1]) % 4 in (2, 3) for v in placed)  # neither enabled nor unknown


def test_shared_view_holds_every_active_entity(spark, tmp_path):
    nations = [(r.n_nationkey, r.n_regionkey) for r in spark.read.parquet(f"{SF_SMALL}/nation.parquet").collect()]
    for name in ("nation", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.createDataFrame([(k, f"Customer#{k}", n, "SEGMENT", 1.0) for k, (n, _) in enumerate(nations)],
                          "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"
                          ).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = curate.shared_view(spark, str(tmp_path)).collect()
    active = {r.global_entity_id for r in domain.config(spark).collect()}
    # EUROPE is settled by the promo tool and active as the others
    assert len(rows) == len(nations) and {r.global_entity_id for r in rows} == active and "EUROPE" in active


def test_promo_merge_joins_lines_once_and_is_dealt_by_order(spark):
    plan = clean.order_campaign_merge(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and plan.count("lineitem.parquet") == 1
    assert "hashpartitioning(country_code" not in plan


def test_promo_versions_of_both_generations(spark, tmp_path):
    at = dt.datetime(1997, 3, 1)
    tables = {
        "customer": spark.createDataFrame([(1, 0)], "c_custkey long, c_nationkey int"),
        "nation": spark.createDataFrame([(0, 3)], "n_nationkey int, n_regionkey int"),
        "region": spark.createDataFrame([(3, "EUROPE")], "r_regionkey int, r_name string"),
        "orders": spark.createDataFrame([(7, 1, at)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "part": spark.createDataFrame([(50, "Brand#2", 10), (50, "Brand#2", 10), (60, "Brand#4", 46)], "p_partkey long, p_brand string, p_size int"),
        "lineitem": spark.createDataFrame([(7, 50, 1, 2.0, 100.0, 0.1, "R"), (7, 60, 3, 1.0, 50.0, 0.0, "N"), (7, 60, 2, 1.0, 50.0, 0.0, "N"), (7, 60, 6, 1.0, 50.0, 0.0, "N"),
                                           (7, 60, None, 1.0, 50.0, 0.0, "N"), (None, 60, 1, 1.0, 50.0, 0.0, "N")],
                                          "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string")}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = [(r["__n"], r.l_linenumber, str(r.discount_lc), r.created_at, str(r.supplier_funded_amount), r.parent_product_id, r.is_combo_product, r.external_funder)
           for r in clean.promo_versions(spark, str(tmp_path)).collect()]
    hour = dt.timedelta(hours=1)
    want = [(0, 1, "10.00", at + hour, "5.00", None, False, "brand"), (0, 1, "9.99", at + 25 * hour, "5.00", None, False, "brand")] * 2 + [
        (0, 3, "0.00", at + 3 * hour, "0.00", 59, True, None), (1, 3, "0.00", at + 3 * hour, "None", None, None, None),
        (1, 6, "0.00", at + 2 * hour, "None", None, None, None)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_nested_catalogue_is_not_dealt_by_warehouse_and_repeats_with_its_parts(spark, tmp_path):
    spark.createDataFrame([(1, 5), (1, 5), (1, 7), (2, 10), (None, 5), (9, 5)], "l_partkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    part = [(1, "red box", "Brand#1", "PROMO"), (1, "blue", "Brand#2", "SMALL"), (2, "green", "Brand#3", "LARGE"), (3, "grey", "Brand#4", "SMALL"), (None, "none", "Brand#5", "SMALL")]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    offers = curate.supplier_warehouses(spark, str(tmp_path)).collect()
    nested = curate.nested_catalogue(spark, str(tmp_path))
    assert "hashpartitioning(warehouse_id" not in nested._jdf.queryExecution().executedPlan().toString()
    got = nested.collect()
    assert sorted((str(r.sku), r.p_brand) for r in got) == sorted((str(k), b) for k, _, b, _ in part)
    for r in got:
        want = sorted((o.warehouse_id, o.supplier_id, o.origin == "direct", t, n.split(" ")) for o in offers if o.sku == r.sku and r.sku is not None
                      for k, n, _, t in part if k == r.sku)
        assert sorted((v.warehouse_id, v.supplier_id, v.is_own_store, v.categories[0].level_one, v.categories[0].details) for v in r.vendor_products or []) == want
        assert r.has_own_store == (any(v[2] for v in want) if want else None)
