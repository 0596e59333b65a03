"""End-to-end jobs: equivalences and invariants on the small fixture."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from promofund.plans import settle_v2
from promofund.streaming import lookback


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_t4_interval_equals_grid(spark):
    a = settle_v2.order_funding(spark, SF_SMALL)
    b = settle_v2.order_funding(spark, SF_SMALL, use_grid=True)
    c = settle_v2.order_funding(spark, SF_SMALL, bucket=None)
    ra = _rows(a)
    assert ra == _rows(b) == _rows(c)
    assert len(ra) > 0
    assert settle_v2.order_funding(spark, SF_MID).exceptAll(settle_v2.order_funding(spark, SF_MID, use_grid=True)).count() == 0


def test_t4_one_row_per_order_sku(spark):
    t4 = settle_v2.order_funding(spark, SF_SMALL)
    assert t4.groupBy("order_id", "sku").count().where("count > 1").count() == 0


def test_t4_statuses_and_branches_occur(spark):
    t4 = settle_v2.order_funding(spark, SF_MID)
    statuses = {r.contract_status for r in t4.select("contract_status").distinct().collect()}
    assert {"configured", "explicit_zero", "missing"} <= statuses
    conv = {r.funding_value_convention_used for r in t4.select("funding_value_convention_used").distinct().collect()}
    assert {"normalized", "per_benefit", "legacy"} <= conv


def test_t5_totals_match_t4(spark):
    t4 = settle_v2.order_funding(spark, SF_SMALL)
    t5 = settle_v2.billing_output(spark, SF_SMALL, t4=t4)
    h = settle_v2.Horizon()
    basis = (F.when(F.col("param_billing_period") == "order_date", F.col("order_date"))
             .when(F.col("param_billing_period") == "campaign_end_date", F.col("campaign_end_date")))
    s4 = (t4.where("funding_amount_lc > 0").where(basis.between(F.lit(h.date_in), F.lit(h.date_fin)))
          .agg(F.sum("funding_amount_lc")).first()[0])
    s5 = t5.agg(F.sum("total_funding_v2_lc")).first()[0]
    assert s4 == s5


def test_run_settlement_writes_steps(spark):
    from promofund.sources.sinks import scratch_path
    out = scratch_path(spark, "v2run")
    paths = settle_v2.run_settlement(spark, SF_SMALL, out, dt.datetime(2025, 1, 6, 10, 30), settle_v2.Horizon())
    t5 = spark.read.parquet(paths["billing_output"]).drop("run_date")
    cols = sorted(t5.columns)
    lazy = settle_v2.billing_output(spark, SF_SMALL).select(*cols)
    assert _rows(t5.select(*cols)) == _rows(lazy)
    t4 = spark.read.parquet(paths["order_funding"])
    assert t4.select("ingested_at").distinct().count() == 1
    health = {r.metric: r.value for r in spark.read.parquet(paths["health"]).collect()}
    assert health["t4_rows"] == float(t4.count()) and health["t5_rows"] == float(t5.count())


def test_two_source_merge_equals_latest_of_union(spark):
    from promofund.operators.dedup import latest_per_key, union_sources
    from promofund.plans import clean
    old, new = clean.raw_sources(spark, SF_SMALL)
    union_latest = latest_per_key(union_sources([(old, "cart", 2), (new, "app", 1)]), ["user_id", "props"], "ts",
                                  tie_break=[F.col("event_id").desc()])
    a = union_latest.select("user_id", "props", "ts", "src", "event_id")
    b = clean.two_source_merge(spark, SF_SMALL).select("user_id", "props", "ts", "src", "event_id")
    assert _rows(a) == _rows(b)


def test_incremental_equals_full(spark):
    from promofund.sources.sinks import replace_partitions, scratch_path
    full = scratch_path(spark, "orders_full")
    replace_partitions(lookback.order_headers(spark, SF_SMALL), full, ["order_month"])
    inc = lookback.incremental_refresh(spark, SF_SMALL, run_date=dt.date(2001, 8, 1))
    assert _rows(spark.read.parquet(full)) == _rows(spark.read.parquet(inc))


def test_backfill_chunks_cover_range():
    chunks = lookback.backfill_chunks(dt.date(1995, 1, 15), dt.date(1997, 3, 1), months=12)
    assert chunks[0].backfill_start == dt.date(1995, 1, 1)
    assert chunks[-1].backfill_end >= dt.date(1997, 3, 1)
    for a, b in zip(chunks, chunks[1:]):
        assert a.backfill_end + dt.timedelta(days=1) == b.backfill_start


def test_stream_equals_batch_on_unordered_files(spark):
    """Three files in no order of time, with re-delivered rows, ties at one
    time, and a key whose only row is far older than all before it."""
    from promofund.operators.dedup import latest_per_key
    from promofund.sources.sinks import scratch_path
    from promofund.streaming import lookback
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    one = ev.limit(1)
    extra = [one.withColumns({"event_id": F.lit(10**9 + n).cast("long"), "user_id": F.lit(u).cast(ev.schema["user_id"].dataType),
                              "ts": F.expr(f"timestamp_ntz'{t}'").cast(ev.schema["ts"].dataType)})
             for n, u, t in ((1, 900001, "2030-01-01 00:00:00"), (2, 900001, "2030-01-01 00:00:00"), (3, 900002, "1990-01-01 00:00:00"))]
    src = scratch_path(spark, "evsrc")
    parts = [ev.where("event_id % 2 = 1 OR event_id % 10 = 0").unionByName(extra[1]), ev.where("event_id % 2 = 0").unionByName(extra[0]),
             ev.where("event_id % 3 = 0").unionByName(extra[2])]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(src)
    every = ev
    for x in extra:
        every = every.unionByName(x)
    exp = latest_per_key(every, ["user_id", "event_type"], "ts", [F.col("event_id").desc()]).select("event_id", "user_id", "event_type")
    for max_files in (1, None):
        out = lookback.latest_stream(spark, src, ["user_id", "event_type"], "ts", tie_break=["event_id"], max_files=max_files)
        assert _rows(out.read(0, 63).select("event_id", "user_id", "event_type")) == _rows(exp)


def test_domain_views_follow_their_files(spark, tmp_path):
    import shutil
    from promofund.sources import domain
    (tmp_path / "in").mkdir()
    for name in os.listdir(SF_SMALL):  # the source folder may be read-only: copy contents, not modes
        if os.path.isfile(os.path.join(SF_SMALL, name)):
            shutil.copyfile(os.path.join(SF_SMALL, name), tmp_path / "in" / name)
    before = domain.campaigns(spark, str(tmp_path / "in")).count()
    rows = spark.read.parquet(f"{SF_SMALL}/part.parquet").limit(5).toPandas()
    rows.to_parquet(tmp_path / "five.parquet")
    os.replace(tmp_path / "five.parquet", tmp_path / "in" / "part.parquet")
    after = domain.campaigns(spark, str(tmp_path / "in")).count()
    assert 0 < after < before
    assert domain.campaigns(spark, str(tmp_path / "in")).count() == after


def test_every_eligible_campaign_is_in_a_run(spark):
    from promofund.plans import settle_v1
    from promofund.sources import domain
    excluded = F.expr(f"global_entity_id = '{settle_v1.EXCLUDED_ENTITY}' and lower(campaign_name) rlike '{settle_v1.EXCLUDED_NAMES}'")
    key = ["global_entity_id", "campaign_id"]
    ready = domain.entity_campaigns(spark, SF_MID).where("state = 'READY' AND is_valid")
    settled = settle_v1.concluded_campaigns(spark, SF_MID).select(key).distinct()
    assert _rows(ready.where(~excluded).select(key).distinct()) == _rows(settled)
    assert ready.where(excluded).count() > 0
    asia = settle_v1.concluded_campaigns(spark, SF_MID, enabled=("ASIA",)).select("global_entity_id").distinct()
    assert [r[0] for r in asia.collect()] == ["ASIA"]


def test_statement_has_one_row_per_entity_and_equals_the_flat_table(spark):
    from promofund.plans import settle_v1
    keys = list(settle_v1._STATEMENT)
    st = settle_v1.supplier_statement(spark, SF_MID)
    flat = settle_v1.sku_funding(spark, SF_MID)
    assert st.count() == st.select(keys).distinct().count() == flat.select(keys).distinct().count() > 0
    # every root of the flat table once per row that L18 lists of it, with its SKUs
    campaigns = st.select(*keys, F.explode("campaigns").alias("c")).select(*keys, "c.root_id", "c.campaign_funded_lc", F.size("c.skus").alias("n"), "c.child_campaigns")
    roots = settle_v1.root_campaigns(spark, SF_MID).groupBy("run_date", "global_entity_id", "root_id").agg(F.count("*").alias("times"))
    want = (flat.groupBy(*keys, "root_id").agg(F.sum("total_funded_lc").cast("decimal(38,2)").alias("f"), F.count("*").alias("n"))
            .join(roots, ["run_date", "global_entity_id", "root_id"]))
    got = campaigns.groupBy(*keys, "root_id").agg(F.max(F.col("campaign_funded_lc").cast("decimal(38,2)")).alias("f"), F.max("n").cast("long").alias("n"),
                                                  F.count("*").alias("times"))
    cols = [*keys, "root_id", "f", "n", "times"]
    assert _rows(got.select(cols)) == _rows(want.select(cols))
    assert campaigns.where("size(child_campaigns) > 0").count() > 0


def test_charged_lines_carry_their_products(spark):
    from promofund.plans import curate, settle_v1
    lines = settle_v1.funded_lines(spark, SF_MID)
    products = {(r.global_entity_id, r.warehouse_id, r.sku, r.platform_vendor_id): (r.supplier_id, r.global_supplier_id, r.product_name, r.barcodes)
                for r in curate.settlement_products(spark, SF_MID).collect()}
    rows = lines.collect()
    for r in rows:
        want = products.get((r.global_entity_id, r.warehouse_id, r.sku, r.platform_vendor_id), (None,) * 4)
        assert (r.supplier_id, r.global_supplier_id, r.product_name, r.barcodes) == want
        assert r.currency_code == settle_v1.CURRENCIES[r.global_entity_id] and r.supplier_funded_amount_lc > 0
    assert {r.product_name is None for r in rows} == {True, False}
    vendor = rows[0].platform_vendor_id
    kept = settle_v1.funded_lines(spark, SF_MID, excluded_vendors=(vendor,))
    assert kept.count() == sum(r.platform_vendor_id != vendor for r in rows)


def test_json_scalar_goes_by_the_value_type(spark):
    from promofund.functions.scalars import json_scalar
    df = spark.createDataFrame([('{"k":"[x]"}',), ('{"k":"{y"}',), ('{"k":[1]}',), ('{"k":{"a":1}}',), ('{"k":7.5}',), ('{"k":true}',), ('{"k":null}',), ("{bad",), (None,)], "t string")
    assert [r.v for r in df.select(json_scalar("t", "$.k").alias("v")).collect()] == ["[x]", "{y", None, None, "7.5", "true", None, None, None]


def test_v1_single_run_equals_all_runs_slice(spark):
    from promofund.plans import settle_v1
    allv = settle_v1.funded_lines(spark, SF_MID)
    # pick the scheduled run with the most charged lines
    top = allv.groupBy("run_date").count().orderBy(F.desc("count"), "run_date").first().run_date
    one = settle_v1.funded_lines(spark, SF_MID, run_date=top)
    assert _rows(one) == _rows(allv.where(F.col("run_date") == F.lit(top)))
    assert settle_v1.horizon_start(dt.date(2001, 7, 31)) == dt.date(2000, 1, 23)
    assert settle_v1._add_months(dt.date(2001, 3, 31), -1) == dt.date(2001, 2, 28)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan          # horizon pushed into the orders scan
    from promofund.sources.sinks import scratch_path
    paths = settle_v1.run_statement(spark, SF_MID, top, scratch_path(spark, "v1run"))
    assert spark.read.parquet(paths["sku_funding"]).count() == settle_v1.sku_funding(spark, SF_MID, run_date=top).count()


def test_v1_entity_list_and_warehouse_exclusion(spark):
    from promofund.plans import settle_v1
    allv = settle_v1.funded_lines(spark, SF_MID)
    asia = settle_v1.funded_lines(spark, SF_MID, enabled=("ASIA",))
    no_w0 = settle_v1.funded_lines(spark, SF_MID, excluded_warehouses=("W0",))
    assert {r.global_entity_id for r in asia.select("global_entity_id").distinct().collect()} <= {"ASIA"}
    assert asia.count() == allv.where("global_entity_id = 'ASIA'").count()
    assert no_w0.where("warehouse_id = 'W0'").count() == 0
    assert no_w0.count() == allv.where("warehouse_id <> 'W0'").count()


def test_nested_campaigns_hold_benefits_triggers_and_vendors(spark):
    from promofund.plans import campaigns, clean
    rows = campaigns.nested_campaigns(spark, SF_SMALL).collect()
    assert len(rows) == campaigns.clean_campaigns(spark, SF_SMALL).count() == len({r.campaign_id for r in rows})
    triggers = {(r.campaign_id, r.sku, r.vendor_id) for r in clean.campaign_triggers(spark, SF_SMALL).collect()}
    vendors = {(r.campaign_id, r.vendor_id, r.n_skus) for r in clean.campaign_vendors(spark, SF_SMALL).collect()}
    known = {r.campaign_id for r in rows}
    assert triggers and {t[0] for t in triggers} <= known
    assert sorted((r.campaign_id, t.sku, t.vendor_id) for r in rows for t in r.triggers) == sorted(triggers)
    assert sorted((r.campaign_id, v.vendor_id, v.n_skus) for r in rows for v in r.vendors) == sorted(vendors)
    assert any(not r.triggers and r.triggers is not None for r in rows)  # family 2 has none


def test_rules_fund_their_own_entity_and_warehouse_only(spark):
    """Every funded line meets a rule of its entity, warehouse, SKU and day; a
    line whose only rules are another warehouse's or entity's gets none."""
    from promofund.sources import domain
    t4 = settle_v2.order_funding(spark, SF_MID).collect()
    rules = settle_v2.funding_rules(spark, SF_MID).collect()
    stores = {}
    for r in settle_v2.campaign_warehouses(spark, SF_MID).collect():
        stores.setdefault((r.global_entity_id, r.campaign_id), set()).add(r.warehouse_id)
    by_sku, by_key = {}, {}
    for r in rules:
        by_sku.setdefault(r.sku, []).append(r)
        for w in stores.get((r.global_entity_id, r.campaign_id), ()):
            by_key.setdefault((r.global_entity_id, w, r.sku), []).append(r)
    strategy = {r.global_entity_id: r.join_strategy for r in domain.config(spark).collect()}
    elsewhere = funded = 0
    for x in t4:
        def fits(r, x=x):
            return r.start_date <= x.order_date <= r.campaign_end_date and (strategy[x.global_entity_id] != "campaign_id" or r.campaign_id == x.campaign_id)
        here = [r for r in by_key.get((x.global_entity_id, x.warehouse_id, x.sku), ()) if fits(r)]
        assert (x.funding_campaign_id is None) == (not here)
        if here:
            funded += 1
            assert x.funding_unit_value == max((r.funding_unit_value for r in here if r.funding_unit_value is not None), default=None)
            assert x.warehouse_name == "Warehouse " + x.warehouse_id[1:]
        elif any(fits(r) for r in by_sku.get(x.sku, ())):
            elsewhere += 1
            assert x.funding_campaign_id is None and x.warehouse_name is None
    assert funded > 20 and elsewhere > funded


def test_supplier_is_that_of_entity_warehouse_and_sku(spark):
    info = {(r.global_entity_id, r.warehouse_id, r.sku): str(r.info_supplier_id) for r in settle_v2.supplier_info(spark, SF_MID).collect()}
    t4 = settle_v2.order_funding(spark, SF_MID).collect()
    assert all(x.supplier_id == info.get((x.global_entity_id, x.warehouse_id, x.sku)) for x in t4)
    assert {x.supplier_id is None for x in t4} == {True, False}


def test_grid_repeats_the_vendors_of_a_warehouse(spark):
    grid = settle_v2.daily_grid(spark, SF_MID)
    keys = ["global_entity_id", "campaign_id", "sku", "warehouse_id", "order_date"]
    most = grid.groupBy(*keys).count().groupBy("global_entity_id", "campaign_id", "warehouse_id").agg(F.max("count").alias("n"), F.min("count").alias("m"))
    n = {(r.global_entity_id, r.campaign_id, r.warehouse_id): r.n_vendors for r in settle_v2.campaign_warehouses(spark, SF_MID).collect()}
    rows = most.collect()
    assert rows and all(r.n == r.m == n[r.global_entity_id, r.campaign_id, r.warehouse_id] for r in rows)


def _broadcast_generates(df):
    """Broadcast exchanges of the planned query whose rows come from a Generate."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    bad = []
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = k + 1
            while below < len(lines) and depth[below] > depth[k]:
                if "Generate " in lines[below]:
                    bad.append(lines[below].strip())
                below += 1
    return bad


def test_no_plan_broadcasts_exploded_rows(spark):
    """Spark estimates an exploded side as its input: it must never be broadcast by estimate."""
    from promofund.plans import curate, histories
    for df in (settle_v2.order_funding(spark, SF_SMALL), settle_v2.order_funding(spark, SF_SMALL, use_grid=True),
               settle_v2.billing_output(spark, SF_SMALL), curate.price_at_order(spark, SF_SMALL), histories.order_line_histories(spark, SF_SMALL)):
        assert _broadcast_generates(df) == []
    one = spark.range(3).select(F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k"))
    assert _broadcast_generates(spark.range(5).withColumnRenamed("id", "k").join(F.broadcast(one), "k"))  # the check sees one


def test_day_grid_is_summarised_before_it_is_spread(spark, monkeypatch):
    t2 = settle_v2.funding_rules(spark, SF_MID)
    held = t2.join(settle_v2.campaign_warehouses(spark, SF_MID), ["global_entity_id", "campaign_id"], "left_semi")
    some = [r.campaign_id for r in held.groupBy("campaign_id").count().orderBy(F.desc("count"), "campaign_id").limit(2).collect()]
    t2 = t2.where(F.col("campaign_id").isin(some))
    # some SKUs a second time, with days of their own
    t2 = t2.unionByName(t2.where("sku % 3 = 0").withColumn("start_date", F.date_add("start_date", 40))
                        .withColumn("campaign_end_date", F.date_add("campaign_end_date", 75))).unionByName(t2.where("sku % 2 = 0")).localCheckpoint()
    keys = ["global_entity_id", "country_code", "campaign_id", "warehouse_id", "warehouse_name"]
    want = (settle_v2.daily_grid(spark, SF_MID, t2=t2).groupBy(*keys, F.trunc("order_date", "month").alias("grid_month"))
            .agg(F.count(F.lit(1)).alias("grid_rows"), F.countDistinct("sku").alias("n_skus"), F.min("order_date").alias("first_day"),
                 F.max("order_date").alias("last_day"), F.sum("funding_unit_value").cast("double").alias("unit_value_days")))
    spread, grid = [], settle_v2.daily_grid
    monkeypatch.setattr(settle_v2, "daily_grid", lambda *a, t2, **k: spread.append(t2.count()) or grid(*a, t2=t2, **k))
    got = settle_v2.daily_grid_summary(spark, SF_MID, t2=t2).withColumn("unit_value_days", F.col("unit_value_days").cast("double"))
    rows = sorted(map(str, map(tuple, got.select(*want.columns).collect())))
    assert rows == sorted(map(str, map(tuple, want.collect()))) and rows
    assert spread[0] < t2.count() / 2  # a few spans a campaign instead of its SKUs


def test_grid_days_do_not_grow_with_the_skus(spark):
    rules = spark.createDataFrame([("ASIA", "W1", "c", dt.date(1994, 12, 30), dt.date(1995, 1, 3), sku) for sku in range(50)],
                                  "global_entity_id string, warehouse_id string, funding_campaign_id string, start_date date, campaign_end_date date, sku int")
    days = [r.grid_date for r in settle_v2.grid_days(rules, settle_v2.Horizon()).collect()]
    assert sorted(days) == [dt.date(1995, 1, 1), dt.date(1995, 1, 2), dt.date(1995, 1, 3)]
