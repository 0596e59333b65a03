"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the domain definition
in FIXTURES.md §3 and the settlement rules. Output conventions shared with the
Spark side: dates -> VARCHAR 'YYYY-MM-DD', money -> DOUBLE (computed exactly in
DECIMAL first), integers -> BIGINT, timestamps -> epoch microseconds.
"""

from __future__ import annotations

# fixed values: the campaign subtypes, stated here a second time so that a
# wrong row in the code under test shows. Columns: campaign_type, applies_to
# ('P': products), discount_type, discount_value test, subtype; first match wins.
PRODUCT_TARGETS = ("PRODUCTS", "CHEAPEST_PRODUCTS")
SUBTYPE_RULES = (
    ("Strikethrough", "P", "ABSOLUTE", None, "Strikethrough $"),
    ("Strikethrough", "P", "PERCENTAGE", None, "Strikethrough %"),
    ("SameItemBundle", "P", "PERCENTAGE", "=100", "Multibuy: Same Item - Free Item"),
    ("SameItemBundle", "P", "PERCENTAGE", "<100", "Multibuy: Same Item %"),
    ("SameItemBundle", "P", "ABSOLUTE", None, "Multibuy: Same Item $"),
    ("SameItemBundle", "DELIVERY_FEE", None, None, "Multibuy: Same Item - Delivery Fee Discount"),
    ("MixAndMatch", "P", "PERCENTAGE", "=100", "Multibuy: Mix & Match - Free Item"),
    ("MixAndMatch", "P", "PERCENTAGE", "<100", "Multibuy: Mix & Match %"),
    ("MixAndMatch", "P", "ABSOLUTE", None, "Multibuy: Mix & Match $"),
    ("MixAndMatch", "DELIVERY_FEE", None, None, "Multibuy: Mix & Match - Delivery Fee Discount"),
    ("BasketValue", "DELIVERY_FEE", None, None, "Basket Discount - Delivery"),
    ("BasketValue", "P", "PERCENTAGE", "=100", "Basket Discount - Free Item"),
    ("BasketValue", "BASKET", "PERCENTAGE", None, "Basket Discount %"),
    ("BasketValue", "BASKET", "ABSOLUTE", None, "Basket Discount $"),
    ("Generic", None, None, None, "Generic"),
)
# end of fixed values


def _subtype_case() -> str:
    """The campaign-subtype table written as a SQL CASE: first match wins, else NULL."""
    targets = ", ".join(f"'{t}'" for t in PRODUCT_TARGETS)
    branches = []
    for ctype, applies, dtype, vtest, subtype in SUBTYPE_RULES:
        cond = [f"campaign_type = '{ctype}'"]
        if applies == "P":
            cond.append(f"applies_to IN ({targets})")
        elif applies is not None:
            cond.append(f"applies_to = '{applies}'")
        if dtype is not None:
            cond.append(f"discount_type = '{dtype}'")
        if vtest == "=100":
            cond.append("discount_value = 100.0")
        elif vtest == "<100":
            cond.append("discount_value < 100.0")
        branches.append(f"WHEN {' AND '.join(cond)} THEN '{subtype}'")
    return "CASE " + " ".join(branches) + " END"


# ----------------------------------------------------------------- domain CTEs
CTE: dict[str, str] = {}

CTE["entities"] = """
entities AS (
  SELECT c.c_custkey, r.r_name AS global_entity_id, lower(substr(r.r_name, 1, 2)) AS country_code, c.c_nationkey AS nationkey
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

CTE["order_lines"] = """
order_lines AS (
  SELECT
    l.l_orderkey AS order_id,
    l.l_partkey AS sku,
    l.l_suppkey AS supplier_id,
    CAST(l.l_quantity AS BIGINT) AS quantity_sold,
    l.l_extendedprice,
    CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS discount_rate,
    l.l_extendedprice / l.l_quantity AS unit_price_listed_lc,
    (l.l_extendedprice / l.l_quantity) * (CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END) AS unit_discount_lc,
    l.l_discount > 0 AS has_discount,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS line_total_lc,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
               * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS line_discount_lc,
    CAST(o.o_orderdate AS DATE) AS order_date,
    e.global_entity_id,
    e.country_code,
    'W' || CAST(o.o_custkey % 5 AS VARCHAR) AS warehouse_id,
    'Warehouse ' || CAST(o.o_custkey % 5 AS VARCHAR) AS warehouse_name,
    'V' || e.nationkey || '-' || (o.o_custkey % 10) AS platform_vendor_id,
    o.o_orderstatus <> 'F' AS is_successful,
    CASE WHEN l.l_discount > 0 THEN 'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) END AS campaign_id,
    CASE WHEN p.p_size % 2 = 0 THEN
      CAST(ROUND(CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
               * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) * 0.5, 2) AS DECIMAL(18,2))
    END AS funding_v1_lc
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN entities e ON o.o_custkey = e.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

CTE["campaign_rows"] = """
campaign_rows AS (
  SELECT *, DATE '1995-01-01' + CAST(start_offset AS INTEGER) AS start_date,
         DATE '1995-01-01' + CAST(start_offset + length_days AS INTEGER) AS end_date
  FROM (
    SELECT 1 AS family, p_partkey, p_size, p_retailprice,
      'C1-' || CAST(CAST(substr(p_brand, 7, 8) AS INTEGER) AS VARCHAR) || '-' || CAST(p_size % 4 AS VARCHAR) AS campaign_id,
      'C1-' || CAST(CAST(substr(p_brand, 7, 8) AS INTEGER) AS VARCHAR) || '-0' AS root_id,
      p_brand || ' promo ' || CAST(p_size % 4 AS VARCHAR) AS campaign_name,
      CASE WHEN p_size % 4 <= 1 THEN 'Strikethrough' WHEN p_size % 4 = 2 THEN 'SameItemBundle' ELSE 'GENERIC' END AS raw_type,
      CASE WHEN p_size % 4 = 1 THEN 'CHEAPEST_PRODUCTS' ELSE 'PRODUCTS' END AS applies_to,
      CASE WHEN p_size % 4 % 2 = 0 THEN 'PERCENTAGE' ELSE 'ABSOLUTE' END AS discount_type,
      CASE WHEN p_size % 4 = 2 THEN CAST(100.0 AS DOUBLE) ELSE CAST((p_size % 4 + 1) * 10 AS DOUBLE) END AS discount_value,
      CAST(substr(p_brand, 7, 8) AS INTEGER) * 80 + (p_size % 4) * 20 AS start_offset,
      (p_size % 4) * 300 + 400 AS length_days,
      CASE WHEN CAST(substr(p_brand, 7, 8) AS INTEGER) % 7 = 0 AND p_size % 4 = 3 THEN 'PAUSED' ELSE 'READY' END AS state,
      TRUE AS is_valid,
      CAST(CASE WHEN p_size % 4 = 3 THEN 0 ELSE p_size % 4 + 1 END AS BIGINT) AS trigger_qty_threshold,
      CAST(CASE WHEN p_size % 4 = 1 THEN 0 WHEN p_size % 4 >= 2 THEN p_size % 4 - 1 END AS BIGINT) AS benefit_qty_limit
    FROM part
    UNION ALL
    SELECT 2 AS family, p_partkey, p_size, p_retailprice,
      'C2-' || p_type || '-' || CAST(p_size % 3 AS VARCHAR),
      'C2-' || p_type || '-0',
      p_type || ' bundle ' || CAST(p_size % 3 AS VARCHAR),
      CASE WHEN p_size % 3 = 1 THEN 'BasketValue' ELSE 'MixAndMatch' END,
      CASE WHEN p_size % 3 = 1 THEN 'BASKET' WHEN p_size % 3 = 2 THEN 'DELIVERY_FEE' ELSE 'PRODUCTS' END,
      CASE WHEN p_size % 3 = 1 THEN 'ABSOLUTE' ELSE 'PERCENTAGE' END,
      CASE WHEN p_size % 3 = 0 THEN CAST(100.0 AS DOUBLE) WHEN p_size % 3 = 1 THEN CAST(5.0 AS DOUBLE) ELSE CAST(50.0 AS DOUBLE) END,
      length(p_type) * 80 + (p_size % 3) * 20,
      (p_size % 3) * 300 + 400,
      'READY',
      NOT (p_type = 'PROMO' AND p_size % 3 = 2),
      CAST(p_size % 3 + 2 AS BIGINT),
      CAST(1 AS BIGINT)
    FROM part WHERE p_partkey % 2 = 0
  ) x
)"""

CTE["campaigns"] = """
campaigns AS (
  SELECT family, campaign_id, root_id, campaign_name, campaign_type,
    """ + _subtype_case() + """ AS campaign_subtype,
    applies_to, discount_type, discount_value, start_date, end_date, state, is_valid,
    trigger_qty_threshold, benefit_qty_limit
  FROM (
    SELECT DISTINCT family, campaign_id, root_id, campaign_name,
      CASE WHEN raw_type IN ('Generic', 'GENERIC', 'OldFashioned Campaign Type') THEN 'Generic' ELSE raw_type END AS campaign_type,
      applies_to, discount_type, discount_value, start_date, end_date, state, is_valid,
      trigger_qty_threshold, benefit_qty_limit
    FROM campaign_rows
  ) d
)"""

CTE["benefits"] = """
benefits AS (
  SELECT campaign_id, p_partkey AS sku,
    CASE WHEN family = 1 THEN (CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 'PERCENTAGE' ELSE 'ABSOLUTE' END)
         ELSE (CASE WHEN p_size % 5 IN (1, 2, 3) THEN 'ABSOLUTE' END) END AS supplier_funding_type,
    CAST(CASE WHEN family = 1 THEN (CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 10.00 WHEN p_size % 5 = 4 THEN 0.00
                                         ELSE ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.05, 2) END)
         ELSE (CASE WHEN p_size % 5 = 0 THEN 3.00 WHEN p_size % 5 = 2 THEN -1.00
                    WHEN p_size % 5 = 3 THEN ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.03, 2)
                    WHEN p_size % 5 = 4 THEN 0.00 END) END AS DECIMAL(18,2)) AS supplier_funding_value,
    CASE WHEN family = 1 AND p_size % 5 >= 2 THEN 'ABSOLUTE' END AS discount_type_sku,
    CAST(CASE WHEN family = 1 AND p_size % 5 >= 2 THEN ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * 0.10, 2) END AS DECIMAL(18,2)) AS discount_value_sku,
    p_partkey % 97 = 13 AS is_deleted
  FROM campaign_rows
)"""

CTE["config_all"] = """
config_all AS (
  SELECT * FROM (VALUES
    ('AFRICA', 'af', 'date_warehouse_sku', TRUE, 'skip', 'normalized', 'negotiated', 'order_date', TRUE),
    ('AMERICA', 'am', 'date_warehouse_sku', FALSE, 'full_discount', 'per_benefit', 'negotiated', 'campaign_end_date', TRUE),
    ('ASIA', 'as', 'campaign_id', TRUE, 'full_discount', 'per_benefit', 'negotiated', 'order_date', TRUE),
    ('EUROPE', 'eu', 'date_warehouse_sku', FALSE, 'skip', 'normalized', 'promotool', 'order_date', TRUE),
    ('MIDDLE EAST', 'mi', 'date_warehouse_sku', TRUE, 'skip', 'legacy', 'negotiated', 'campaign_end_date', TRUE),
    ('ANTARCTICA', 'an', 'date_warehouse_sku', TRUE, 'skip', 'normalized', 'negotiated', 'order_date', FALSE)
  ) AS t(global_entity_id, country_code, join_strategy, require_discount_to_charge, missing_contract_fallback,
         funding_value_convention, funding_source, param_billing_period, is_active)
)"""

CTE["config"] = """
config AS (SELECT * FROM config_all WHERE is_active = TRUE)"""

# ----------------------------------------------------------------- settlement v2
CTE["pairs"] = """
pairs AS (SELECT DISTINCT l_partkey AS sku, l_suppkey AS supplier_id, 'W' || CAST(l_suppkey % 5 AS VARCHAR) AS warehouse_id
          FROM lineitem)"""
CTE["rep"] = """
rep AS (SELECT * FROM (VALUES ('W0', 'W1'), ('W0', 'W2'), ('W3', 'W4')) t(dc_warehouse_id, store_warehouse_id))"""
CTE["offers"] = """
offers AS (
  SELECT sku, supplier_id, warehouse_id, 'direct' AS origin FROM pairs
  WHERE warehouse_id NOT IN (SELECT dc_warehouse_id FROM rep)
  UNION ALL
  SELECT p.sku, p.supplier_id, r.store_warehouse_id AS warehouse_id, 'dc' AS origin
  FROM pairs p JOIN rep r ON p.warehouse_id = r.dc_warehouse_id
)"""
CTE["vendors"] = """
vendors AS (
  SELECT r_name AS global_entity_id, n_nationkey, k, 'V' || n_nationkey || '-' || k AS vendor_id,
    CASE WHEN (n_nationkey + 3 * k) % 13 = 6 THEN NULL WHEN (n_nationkey + k) % 11 = 0 THEN '' ELSE 'W' || (k % 5) END AS warehouse_id,
    (n_nationkey + 2 * k) % 7 <> 0 AS is_dmart
  FROM nation JOIN region ON n_regionkey = r_regionkey, generate_series(0, 9) AS b(k)
)"""
# products of open dark-store branches
CTE["dmart"] = """
dmart AS (
  SELECT DISTINCT v.global_entity_id, p.sku, v.vendor_id, v.warehouse_id
  FROM pairs p JOIN supplier s ON p.supplier_id = s.s_suppkey
  JOIN vendors v ON v.n_nationkey = s.s_nationkey AND v.k = s.s_suppkey % 10
  WHERE v.is_dmart AND v.warehouse_id <> ''
)"""
CTE["entity_campaigns"] = """
entity_campaigns AS (
  SELECT c.*, r.r_name AS global_entity_id, lower(substr(r.r_name, 1, 2)) AS country_code,
    CASE WHEN c.step % 3 <> 0 THEN 'R' || (c.step % 3) END AS reason, CAST(c.start_date - CAST(c.step % 20 AS INTEGER) AS TIMESTAMP) AS created_at_utc
  FROM (
    SELECT *, CAST(right(campaign_id, 1) AS INTEGER) AS bucket,
      CAST(right(campaign_id, 1) AS INTEGER) + CASE WHEN family = 1 THEN CAST(split_part(campaign_id, '-', 2) AS INTEGER)
                                                    ELSE length(campaign_id) - 5 END AS step FROM campaigns) c
  JOIN region r ON r.r_regionkey = c.step % 5 OR (c.family = 2 AND c.bucket = 0 AND r.r_regionkey = (c.step + 2) % 5)
)"""
CTE["campaign_vendors"] = """
campaign_vendors AS (
  SELECT e.global_entity_id, e.campaign_id, v.vendor_id
  FROM entity_campaigns e JOIN vendors v ON e.global_entity_id = v.global_entity_id AND (v.n_nationkey + v.k + e.step) % 8 = 0
)"""
# a row per campaign and vendor that still has a warehouse
CTE["campaign_stores"] = """
campaign_stores AS (
  SELECT cv.global_entity_id, cv.campaign_id, d.warehouse_id, 'Warehouse ' || substr(d.warehouse_id, 2) AS warehouse_name
  FROM campaign_vendors cv JOIN (SELECT DISTINCT global_entity_id, vendor_id, warehouse_id FROM dmart) d
    ON cv.global_entity_id = d.global_entity_id AND cv.vendor_id = d.vendor_id
)"""
CTE["supplier_info"] = """
supplier_info AS (
  SELECT global_entity_id, warehouse_id, sku, supplier_id, supplier_name FROM (
    SELECT r.r_name AS global_entity_id, o.warehouse_id, o.sku, o.supplier_id, s.s_name AS supplier_name,
      ROW_NUMBER() OVER (PARTITION BY r.r_name, o.sku, o.warehouse_id ORDER BY (s.s_acctbal > 5000) DESC NULLS LAST, o.supplier_id DESC) AS rn
    FROM offers o JOIN supplier s ON o.supplier_id = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey) x WHERE rn = 1
)"""
CTE["t1"] = """
t1 AS (
  SELECT c.* FROM entity_campaigns c JOIN config cfg ON c.global_entity_id = cfg.global_entity_id
  WHERE c.state = 'READY' AND c.is_valid = TRUE
    AND CAST(c.start_date AS TIMESTAMP) <= TIMESTAMP '2001-12-31 00:00:00'
    AND CAST(c.end_date AS TIMESTAMP) >= TIMESTAMP '1995-01-01 00:00:00'
    AND EXISTS (SELECT 1 FROM benefits b JOIN dmart d ON b.sku = d.sku
                WHERE b.campaign_id = c.campaign_id AND d.global_entity_id = c.global_entity_id)
)"""

CTE["t2"] = """
t2 AS (
  SELECT t1.global_entity_id, t1.country_code, t1.campaign_id, t1.campaign_type, b.sku, b.supplier_funding_type, b.supplier_funding_value,
    CASE WHEN b.supplier_funding_type IS NULL AND b.supplier_funding_value IS NULL THEN 'missing'
         WHEN b.supplier_funding_value = 0 THEN 'explicit_zero'
         WHEN b.supplier_funding_type IS NOT NULL AND b.supplier_funding_value > 0 THEN 'configured'
         ELSE 'missing' END AS contract_status,
    CASE WHEN b.supplier_funding_type = 'ABSOLUTE' AND b.supplier_funding_value > 0 THEN b.supplier_funding_value
         WHEN b.supplier_funding_value = 0 THEN CAST(0 AS DECIMAL(18,2)) END AS funding_unit_value,
    COALESCE(b.discount_type_sku, t1.discount_type) AS discount_type_resolved,
    COALESCE(CAST(b.discount_value_sku AS DOUBLE), t1.discount_value) AS discount_value_resolved,
    t1.trigger_qty_threshold, t1.benefit_qty_limit, t1.start_date, t1.end_date AS campaign_end_date
  FROM t1 JOIN benefits b ON t1.campaign_id = b.campaign_id
  WHERE b.sku IS NOT NULL AND b.is_deleted = FALSE
)"""

CTE["t4_lines"] = """
t4_lines AS (
  SELECT ol.* EXCLUDE (warehouse_name), cfg.join_strategy, cfg.require_discount_to_charge, cfg.missing_contract_fallback,
         cfg.funding_value_convention, cfg.funding_source, cfg.param_billing_period
  FROM order_lines ol JOIN config cfg ON ol.global_entity_id = cfg.global_entity_id
  WHERE ol.country_code = cfg.country_code AND ol.is_successful = TRUE AND ol.quantity_sold > 0
    AND ol.order_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
)"""

CTE["t2_stores"] = """
t2_stores AS (
  SELECT t2.*, s.warehouse_id, s.warehouse_name
  FROM t2 JOIN campaign_stores s ON t2.global_entity_id = s.global_entity_id AND t2.campaign_id = s.campaign_id
)"""

T4_MATCH_GRID = """
t4_match AS (
  SELECT o.*, r.warehouse_name, r.campaign_id AS funding_campaign_id, r.campaign_type, r.contract_status,
         r.supplier_funding_type, r.supplier_funding_value, r.funding_unit_value, r.trigger_qty_threshold,
         r.benefit_qty_limit, r.discount_type_resolved, r.discount_value_resolved, r.campaign_end_date
  FROM t4_lines o LEFT JOIN (
    SELECT g.*, CAST(d AS DATE) AS grid_date
    FROM t2_stores g, generate_series(g.start_date, g.campaign_end_date, INTERVAL 1 DAY) AS s(d)
  ) r
    ON o.global_entity_id = r.global_entity_id AND o.warehouse_id = r.warehouse_id AND o.sku = r.sku AND o.order_date = r.grid_date
   AND (o.join_strategy <> 'campaign_id' OR o.campaign_id = r.campaign_id)
)"""

CTE["t4_match"] = """
t4_match AS (
  SELECT o.*, r.warehouse_name, r.campaign_id AS funding_campaign_id, r.campaign_type, r.contract_status,
         r.supplier_funding_type, r.supplier_funding_value, r.funding_unit_value, r.trigger_qty_threshold,
         r.benefit_qty_limit, r.discount_type_resolved, r.discount_value_resolved, r.campaign_end_date
  FROM t4_lines o LEFT JOIN t2_stores r
    ON o.global_entity_id = r.global_entity_id AND o.warehouse_id = r.warehouse_id AND o.sku = r.sku AND o.order_date BETWEEN r.start_date AND r.campaign_end_date
   AND (o.join_strategy <> 'campaign_id' OR o.campaign_id = r.campaign_id)
)"""

CTE["t4_dedup"] = """
t4_dedup AS (
  SELECT * FROM (
    SELECT m.*, ROW_NUMBER() OVER (
      PARTITION BY order_id, sku
      ORDER BY funding_unit_value DESC NULLS LAST, funding_campaign_id ASC NULLS LAST,
               quantity_sold DESC, l_extendedprice DESC, discount_rate DESC, supplier_id ASC) AS rn
    FROM t4_match m) x
  WHERE rn = 1
)"""

CTE["t4"] = """
t4 AS (
  SELECT f.*,
    CASE funding_source WHEN 'negotiated' THEN funding_total_lc
                        WHEN 'promotool' THEN COALESCE(funding_v1_lc, CAST(0 AS DECIMAL(18,2))) END AS funding_amount_lc,
    CASE funding_source WHEN 'negotiated' THEN funding_total_lc - COALESCE(funding_v1_lc, CAST(0 AS DECIMAL(18,2)))
                        WHEN 'promotool' THEN CAST(0 AS DECIMAL(18,2)) END AS delta_lc
  FROM (
    SELECT d.*,
      CAST(CASE
        WHEN require_discount_to_charge = TRUE AND has_discount = FALSE THEN 0
        WHEN contract_status = 'missing' AND missing_contract_fallback = 'skip' THEN 0
        WHEN contract_status = 'missing' AND missing_contract_fallback = 'full_discount' THEN ROUND(line_discount_lc, 2)
        WHEN contract_status = 'explicit_zero' THEN 0
        WHEN funding_unit_value IS NULL THEN 0
        WHEN funding_value_convention = 'normalized' THEN ROUND(funding_unit_value * quantity_sold, 2)
        WHEN funding_value_convention = 'per_benefit' THEN ROUND(funding_unit_value *
             CASE WHEN trigger_qty_threshold IS NULL OR trigger_qty_threshold = 0 THEN NULL
                  ELSE LEAST(quantity_sold // trigger_qty_threshold,
                             COALESCE(NULLIF(benefit_qty_limit, 0), quantity_sold // trigger_qty_threshold)) END, 2)
        ELSE 0
      END AS DECIMAL(18,2)) AS funding_total_lc
    FROM t4_dedup d
  ) f
)"""

T4_SELECT = """
SELECT d.global_entity_id, d.order_id, CAST(d.order_date AS VARCHAR) AS order_date, d.warehouse_id,
  CAST(s.supplier_id AS VARCHAR) AS supplier_id, s.supplier_name, d.sku, d.campaign_id,
  d.funding_campaign_id, qa.root_id, qf.root_id AS funding_root_id, d.campaign_type,
  qa.campaign_subtype, qf.campaign_subtype AS funding_campaign_subtype,
  d.quantity_sold, d.unit_price_listed_lc, d.unit_discount_lc, CAST(d.line_total_lc - d.line_discount_lc AS DOUBLE) AS net_sales_lc,
  d.has_discount, d.contract_status, d.supplier_funding_type,
  CAST(d.supplier_funding_value AS DOUBLE) AS supplier_funding_value,
  CAST(d.funding_unit_value AS DOUBLE) AS funding_unit_value,
  d.trigger_qty_threshold, d.benefit_qty_limit, d.discount_type_resolved, d.discount_value_resolved,
  CAST(d.campaign_end_date AS VARCHAR) AS campaign_end_date, d.warehouse_name,
  CAST(d.funding_total_lc AS DOUBLE) AS funding_total_lc,
  CAST(d.funding_amount_lc AS DOUBLE) AS funding_amount_lc,
  CAST(COALESCE(d.funding_v1_lc, 0) AS DOUBLE) AS funding_v1_lc,
  CAST(d.delta_lc AS DOUBLE) AS delta_lc,
  d.contract_status = 'missing' AS fallback_applied,
  d.join_strategy AS join_method_used,
  d.funding_value_convention AS funding_value_convention_used
FROM t4 d
LEFT JOIN supplier_info s ON d.global_entity_id = s.global_entity_id AND d.warehouse_id = s.warehouse_id AND d.sku = s.sku
LEFT JOIN entity_campaigns qa ON d.global_entity_id = qa.global_entity_id AND d.campaign_id = qa.campaign_id
LEFT JOIN entity_campaigns qf ON d.global_entity_id = qf.global_entity_id AND d.funding_campaign_id = qf.campaign_id
"""

T5_SELECT = """
SELECT global_entity_id, CAST(billing_month AS VARCHAR) AS billing_month, supplier_id, supplier_name,
  warehouse_id, warehouse_name,
  COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT sku) AS total_skus,
  COUNT(DISTINCT campaign_id) AS total_campaigns,
  CAST(ROUND(SUM(funding_amount_lc), 2) AS DOUBLE) AS total_funding_v2_lc,
  CAST(ROUND(SUM(funding_v1_lc), 2) AS DOUBLE) AS total_funding_v1_lc,
  CAST(ROUND(SUM(delta_lc), 2) AS DOUBLE) AS total_delta_lc,
  COUNT(*) FILTER (WHERE fallback_applied = TRUE) AS fallback_orders,
  'v2' AS settlement_version
FROM (
  SELECT d.global_entity_id, CAST(s.supplier_id AS VARCHAR) AS supplier_id, s.supplier_name,
    d.warehouse_id, d.warehouse_name, d.order_id, d.sku, d.campaign_id, d.funding_amount_lc,
    COALESCE(d.funding_v1_lc, 0) AS funding_v1_lc, d.delta_lc, d.contract_status = 'missing' AS fallback_applied,
    CAST(date_trunc('month', CASE d.param_billing_period WHEN 'order_date' THEN d.order_date
                                                         WHEN 'campaign_end_date' THEN d.campaign_end_date END) AS DATE) AS billing_month
  FROM t4 d LEFT JOIN supplier_info s ON d.global_entity_id = s.global_entity_id AND d.warehouse_id = s.warehouse_id AND d.sku = s.sku
  WHERE CASE d.param_billing_period WHEN 'order_date' THEN d.order_date
                                    WHEN 'campaign_end_date' THEN d.campaign_end_date END
        BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    AND d.funding_amount_lc > 0
) pre
GROUP BY global_entity_id, billing_month, supplier_id, supplier_name, warehouse_id, warehouse_name
"""

V2_RULES = ["config_all", "config", "campaign_rows", "campaigns", "benefits", "pairs", "vendors", "dmart", "entity_campaigns",
            "campaign_vendors", "campaign_stores", "t1", "t2", "t2_stores"]
V2_CHAIN = ["entities", "order_lines", *V2_RULES, "rep", "offers", "supplier_info", "t4_lines", "t4_match", "t4_dedup", "t4"]


def with_ctes(names, body: str, overrides: dict[str, str] | None = None) -> str:
    parts = []
    for n in names:
        parts.append((overrides or {}).get(n, CTE[n]).strip())
    return "WITH " + ",\n".join(parts) + "\n" + body


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["order_funding"] = with_ctes(V2_CHAIN, T4_SELECT)
    q["order_funding_grid"] = with_ctes(V2_CHAIN, T4_SELECT, {"t4_match": T4_MATCH_GRID})
    q["billing_output"] = with_ctes(V2_CHAIN, T5_SELECT)
    return q


# ----------------------------------------------------------------- v2: T1, T2, T3
T1_SELECT = """
SELECT global_entity_id, country_code, campaign_id, root_id, campaign_name, campaign_type, campaign_subtype, discount_type, discount_value,
  epoch_us(CAST(start_date AS TIMESTAMP)) AS start_at_utc, epoch_us(CAST(end_date AS TIMESTAMP)) AS end_at_utc,
  state, is_valid, trigger_qty_threshold, benefit_qty_limit,
  (SELECT COUNT(*) FROM campaign_vendors v WHERE v.global_entity_id = t1.global_entity_id AND v.campaign_id = t1.campaign_id) AS n_vendors
FROM t1
"""

T2_SELECT = """
SELECT global_entity_id, country_code, campaign_id, campaign_type, sku, supplier_funding_type, CAST(supplier_funding_value AS DOUBLE) AS supplier_funding_value,
  contract_status, CAST(funding_unit_value AS DOUBLE) AS funding_unit_value, discount_type_resolved, discount_value_resolved,
  trigger_qty_threshold, benefit_qty_limit, CAST(start_date AS VARCHAR) AS start_date,
  CAST(campaign_end_date AS VARCHAR) AS campaign_end_date
FROM t2
"""

T3_SUMMARY = """
SELECT global_entity_id, country_code, campaign_id, warehouse_id, warehouse_name,
  CAST(date_trunc('month', d) AS DATE)::VARCHAR AS grid_month, COUNT(*) AS grid_rows,
  COUNT(DISTINCT sku) AS n_skus, CAST(MIN(d) AS VARCHAR) AS first_day, CAST(MAX(d) AS VARCHAR) AS last_day,
  CAST(SUM(funding_unit_value) AS DOUBLE) AS unit_value_days
FROM (SELECT g.*, CAST(s.d AS DATE) AS d
      FROM t2_stores g, generate_series(g.start_date, g.campaign_end_date, INTERVAL 1 DAY) AS s(d)) x
GROUP BY global_entity_id, country_code, campaign_id, warehouse_id, warehouse_name, CAST(date_trunc('month', d) AS DATE)
"""



def _v2_extra(q: dict[str, str]) -> None:
    q["campaigns_in_use"] = with_ctes(V2_RULES, T1_SELECT)
    q["rules_contract_status"] = with_ctes(V2_RULES, T2_SELECT)
    q["daily_grid"] = with_ctes(V2_RULES, T3_SUMMARY)


_EXTRA = [_v2_extra]
_base_oracle = oracle_sql


def oracle_sql() -> dict[str, str]:  # noqa: F811 (extended registry)
    q = _base_oracle()
    for fn in _EXTRA:
        fn(q)
    return q


# ----------------------------------------------------------------- calendar
CTE["run_dates"] = """
run_dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)"""

CTE["windows"] = """
windows AS (
  SELECT run_date, week_monday, month_first, fnm AS is_first_of_month_not_monday, fma AS is_first_monday_after_first,
    CASE WHEN fnm THEN week_monday WHEN fma THEN month_first ELSE week_monday - 7 END AS start_date,
    CASE WHEN fnm THEN last_day(run_date) WHEN fma THEN run_date - 1 ELSE week_monday - 1 END AS end_date
  FROM (
    SELECT run_date, CAST(date_trunc('week', run_date) AS DATE) AS week_monday,
      CAST(date_trunc('month', run_date) AS DATE) AS month_first,
      (day(run_date) = 1 AND isodow(run_date) <> 1) AS fnm,
      (isodow(run_date) = 1 AND run_date > CAST(date_trunc('month', run_date) AS DATE)
        AND run_date <= CAST(date_trunc('month', run_date) AS DATE) + 6) AS fma
    FROM run_dates) x
)"""


def _calendar(q: dict[str, str]) -> None:
    q["settlement_window"] = with_ctes(["run_dates", "windows"], """
SELECT CAST(run_date AS VARCHAR) AS run_date, CAST(week_monday AS VARCHAR) AS week_monday,
  CAST(month_first AS VARCHAR) AS month_first, is_first_of_month_not_monday, is_first_monday_after_first,
  CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM windows""")
    q["window_partitions"] = with_ctes(["run_dates", "windows"], """
SELECT DISTINCT CAST(run_date AS VARCHAR) AS run_date, CAST(CAST(s.d AS DATE) AS VARCHAR) AS partition_date
FROM windows w, generate_series(w.start_date, w.end_date, INTERVAL 1 DAY) AS s(d)
WHERE w.start_date <= w.end_date""")
    q["load_mode_filter"] = with_ctes(["run_dates"], """
SELECT CAST(r.run_date AS VARCHAR) AS run_date, CAST(r.run_date - 8 AS VARCHAR) AS window_lo,
  CAST(r.run_date + 1 AS VARCHAR) AS window_hi,
  CAST(CAST(date_trunc('month', r.run_date - 8) AS DATE) AS VARCHAR) AS month_lo,
  CAST(CAST(date_trunc('month', r.run_date + 1) AS DATE) AS VARCHAR) AS month_hi,
  (SELECT COUNT(*) FROM orders o WHERE CAST(o.o_orderdate AS DATE) BETWEEN r.run_date - 8 AND r.run_date + 1) AS n_orders
FROM run_dates r""")
    q["rolling_horizon"] = """
SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
  (CAST(o_orderdate AS DATE) >= CAST(DATE '2001-07-31' - INTERVAL 20 MONTH AS DATE)
   AND CAST(o_orderdate AS DATE) >= CAST(DATE '2001-07-23' - INTERVAL 18 MONTH AS DATE)) AS in_horizon
FROM orders"""
    q["billing_month"] = with_ctes(["entities", "config_all", "config"], """
SELECT o.o_orderkey AS order_id, e.global_entity_id, c.param_billing_period,
  CAST(CAST(date_trunc('month', CASE c.param_billing_period WHEN 'order_date' THEN CAST(o.o_orderdate AS DATE)
                                      WHEN 'campaign_end_date' THEN ls.campaign_end_date END) AS DATE) AS VARCHAR) AS billing_month
FROM orders o JOIN entities e ON o.o_custkey = e.c_custkey
JOIN config c ON e.global_entity_id = c.global_entity_id
LEFT JOIN (SELECT l_orderkey, CAST(MAX(l_shipdate) AS DATE) AS campaign_end_date FROM lineitem GROUP BY l_orderkey) ls
  ON o.o_orderkey = ls.l_orderkey""")


_EXTRA.append(_calendar)


# ----------------------------------------------------------------- clean layer (events as raw sources)
CTE["src_old"] = """
src_old AS (SELECT event_id, ts, user_id, event_type, value, props, 'cart' AS src, CAST(2 AS BIGINT) AS src_priority
            FROM events WHERE event_type IN ('view', 'click'))"""
CTE["src_new"] = """
src_new AS (SELECT event_id, ts, user_id, event_type, CAST(NULL AS DOUBLE) AS value, props, 'app' AS src, CAST(1 AS BIGINT) AS src_priority
            FROM events WHERE event_type NOT IN ('view', 'click'))"""
CTE["src_union"] = """
src_union AS (SELECT * FROM src_old UNION ALL SELECT * FROM src_new)"""


def _clean(q: dict[str, str]) -> None:
    q["latest_per_key"] = """
SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM (
  SELECT e.*, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events e) x WHERE rn = 1"""
    q["priority_dedupe"] = with_ctes(["src_old", "src_new", "src_union"], """
SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props, src, src_priority FROM (
  SELECT u.*, ROW_NUMBER() OVER (PARTITION BY user_id, props ORDER BY src_priority ASC NULLS LAST, ts DESC NULLS LAST, event_id DESC) AS rn
  FROM src_union u) x WHERE rn = 1""")
    q["two_source_merge"] = with_ctes(["src_old", "src_new", "src_union"], """
SELECT w.user_id, w.props, epoch_us(w.ts) AS ts, w.src, s.event_id, s.event_type, COALESCE(s.value, 0.0) AS value
FROM (
  SELECT user_id, props, ts, src FROM (
    SELECT u.*, ROW_NUMBER() OVER (PARTITION BY user_id, props ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
    FROM src_union u) x WHERE rn = 1) w
JOIN src_union s ON s.src = w.src AND s.user_id = w.user_id AND s.props = w.props AND s.ts = w.ts""")
    q["json_scalar"] = """
SELECT event_id,
  CASE WHEN json_type(props, '$.k') IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(props, '$.k') END AS k_text,
  TRY_CAST(CASE WHEN json_type(props, '$.k') IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS k_num,
  CASE WHEN json_type(props, '$') IN ('OBJECT', 'ARRAY') THEN NULL ELSE json_extract_string(props, '$') END AS root_scalar
FROM events"""
    q["validity_from_lag"] = """
SELECT event_id, epoch_us(ts) AS valid_from,
  epoch_us(LEAD(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts ASC, event_id ASC)) AS valid_to,
  epoch_us(LAG(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC)) AS quirk_valid_from
FROM events"""
    q["multi_key_dedupe"] = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, epoch_us(l_shipdate) AS l_shipdate FROM (
  SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_partkey, l_suppkey, l_quantity,
             l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem l) x WHERE rn = 1"""


_EXTRA.append(_clean)


# ----------------------------------------------------------------- curated layer
CTE["hist"] = """
hist AS (
  SELECT sku, valid_from, unit_price,
    COALESCE(LEAD(valid_from) OVER (PARTITION BY sku ORDER BY valid_from), DATE '9999-12-31') AS valid_to
  FROM (SELECT l_partkey AS sku, CAST(l_shipdate AS DATE) AS valid_from, MAX(l_extendedprice / l_quantity) AS unit_price
        FROM lineitem GROUP BY 1, 2) x
)"""
CTE["dated_lines"] = """
dated_lines AS (
  SELECT l.l_orderkey, l.l_partkey AS sku, l.l_linenumber, CAST(o.o_orderdate AS DATE) AS order_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""
_PRICE_AT = """
SELECT l.l_orderkey, l.sku, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, CAST(l.order_date AS VARCHAR) AS order_date,
  CAST(h.valid_from AS VARCHAR) AS valid_from, CAST(h.valid_to AS VARCHAR) AS valid_to, h.unit_price
FROM dated_lines l LEFT JOIN hist h ON l.sku = h.sku AND l.order_date >= h.valid_from AND l.order_date {op} h.valid_to"""


def _curate(q: dict[str, str]) -> None:
    q["interval_join_closed"] = with_ctes(["hist", "dated_lines"], _PRICE_AT.format(op="<="))
    q["interval_join_halfopen"] = with_ctes(["hist", "dated_lines"], _PRICE_AT.format(op="<"))
    q["fallback_join"] = """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey,
  NULLIF(l.l_returnflag, 'N') AS flag, COALESCE(a.unit_cost, b.unit_cost) AS unit_cost,
  CASE WHEN a.l_partkey IS NOT NULL THEN 'supplier' WHEN b.p_partkey IS NOT NULL THEN 'catalogue' END AS cost_source,
  fs.flag_lines, fs.flag_max_discount
FROM lineitem l
LEFT JOIN (SELECT l_partkey, l_suppkey, MIN(l_extendedprice / l_quantity) AS unit_cost
           FROM lineitem WHERE l_suppkey % 4 = 0 GROUP BY 1, 2) a
  ON l.l_partkey = a.l_partkey AND l.l_suppkey = a.l_suppkey
LEFT JOIN (SELECT p_partkey, p_retailprice * 0.5 AS unit_cost FROM part) b
  ON l.l_partkey = b.p_partkey AND a.l_partkey IS NULL
LEFT JOIN (SELECT NULLIF(l_returnflag, 'N') AS s_flag, COUNT(*) AS flag_lines, MAX(l_discount) AS flag_max_discount
           FROM lineitem GROUP BY 1) fs
  ON NULLIF(l.l_returnflag, 'N') IS NOT DISTINCT FROM fs.s_flag"""
    q["anti_join_remap"] = with_ctes(["pairs", "rep", "offers"], "SELECT sku, supplier_id, warehouse_id, origin FROM offers")
    q["preferred_supplier"] = with_ctes(["pairs", "rep", "offers"], """
SELECT sku, warehouse_id, supplier_id, supplier_name, origin, is_preferred FROM (
  SELECT o.*, s.s_name AS supplier_name, s.s_acctbal > 5000 AS is_preferred,
    ROW_NUMBER() OVER (PARTITION BY o.sku, o.warehouse_id ORDER BY (s.s_acctbal > 5000) DESC NULLS LAST, o.supplier_id DESC) AS rn
  FROM offers o JOIN supplier s ON o.supplier_id = s.s_suppkey) x WHERE rn = 1""")
    q["nest_orders"] = """
SELECT o.o_orderkey AS order_id, COUNT(l.l_orderkey) AS n_items,
  COALESCE(string_agg(CAST(l.l_partkey AS VARCHAR), ',' ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity,
                      l.l_extendedprice, l.l_discount), '') AS item_skus,
  COALESCE(SUM(l.l_quantity), 0.0) AS total_qty
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey"""
    q["nest_unnest_roundtrip"] = """
SELECT o.o_orderkey AS order_id,
  CASE WHEN l.l_orderkey IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY o.o_orderkey
       ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount) - 1 END AS pos,
  CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""
    q["distinct_join_string"] = """
SELECT l_orderkey AS order_id,
  array_to_string(list_sort(list_distinct(list(l_returnflag || l_linestatus))), ',') AS status_codes,
  bool_or(l_discount > 0.05) AS any_big_discount, bool_or(l_returnflag = 'R') AS any_returned
FROM lineitem GROUP BY l_orderkey"""


_EXTRA.append(_curate)


# ----------------------------------------------------------------- settlement v1
CTE["runs"] = """
runs AS (SELECT run_date, start_date AS window_start, end_date AS window_end FROM windows
         WHERE isodow(run_date) = 1 OR day(run_date) = 1)"""
# scheduled runs follow the calendar, not the order days
CTE["v1_run_dates"] = """
run_dates AS (
  SELECT CAST(s.d AS DATE) AS run_date
  FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders) o,
       (SELECT MAX(end_date) AS last_end FROM campaigns) c,
       generate_series(o.lo, greatest(o.hi, c.last_end + 7), INTERVAL 1 DAY) AS s(d))"""
CTE["fc"] = """
fc AS (
  SELECT r.run_date, r.window_start, r.window_end, c.global_entity_id, c.country_code, c.campaign_id, c.root_id, c.campaign_name, c.campaign_type,
    c.campaign_subtype, c.reason, c.created_at_utc, CAST(c.start_date AS TIMESTAMP) AS start_at_utc, CAST(c.end_date AS TIMESTAMP) AS end_at_utc
  FROM entity_campaigns c JOIN runs r ON c.end_date BETWEEN r.window_start AND r.window_end
  WHERE c.state = 'READY' AND c.is_valid = TRUE
    AND (c.global_entity_id <> 'MIDDLE EAST' OR NOT regexp_matches(lower(c.campaign_name), 'brand#1|small bundle'))
)"""
CTE["rc_rows"] = """
rc_rows AS (
  SELECT c.run_date, c.window_start, c.window_end, c.global_entity_id, c.country_code,
    COALESCE(r.campaign_id, c.root_id) AS g_campaign_id, COALESCE(r.root_id, c.root_id) AS g_root_id,
    COALESCE(r.campaign_name, c.campaign_name) AS g_name, COALESCE(r.campaign_type, c.campaign_type) AS g_type,
    COALESCE(r.campaign_subtype, c.campaign_subtype) AS g_subtype, COALESCE(r.reason, c.reason) AS g_reason,
    COALESCE(d.min_created, c.created_at_utc) AS g_created,
    COALESCE(d.min_start, c.start_at_utc) AS g_start, COALESCE(d.max_end, c.end_at_utc) AS g_end,
    c.campaign_id, c.root_id, c.campaign_name, c.campaign_type, c.campaign_subtype, c.reason, c.created_at_utc, c.start_at_utc, c.end_at_utc
  FROM fc c
  LEFT JOIN fc r ON c.run_date = r.run_date AND c.global_entity_id = r.global_entity_id AND c.country_code = r.country_code
    AND c.root_id = r.campaign_id AND r.campaign_id = r.root_id
  LEFT JOIN (SELECT run_date, global_entity_id, country_code, root_id, MIN(created_at_utc) AS min_created, MIN(start_at_utc) AS min_start,
               MAX(end_at_utc) AS max_end
             FROM fc WHERE root_id IS NOT NULL GROUP BY 1, 2, 3, 4) d
    ON c.run_date = d.run_date AND c.global_entity_id = d.global_entity_id AND c.country_code = d.country_code AND c.root_id = d.root_id
  WHERE c.root_id IS NOT NULL
)"""
CTE["roots"] = """
roots AS (
  SELECT run_date, window_start, window_end, global_entity_id, country_code, g_campaign_id AS campaign_id, g_root_id AS root_id,
    g_name AS campaign_name, g_type AS campaign_type, g_subtype AS campaign_subtype, g_reason AS reason, g_created AS campaign_created_at_utc,
    g_start AS campaign_start_at_utc, g_end AS campaign_end_at_utc,
    COUNT(CASE WHEN campaign_id <> root_id THEN 1 END) AS n_children,
    COALESCE(string_agg(CASE WHEN campaign_id <> root_id THEN campaign_id END, ','
             ORDER BY campaign_id, campaign_name, campaign_type, campaign_subtype, reason, created_at_utc, start_at_utc, end_at_utc), '') AS child_ids
  FROM rc_rows GROUP BY ALL
)"""
CTE["flat"] = """
flat AS (
  SELECT run_date, window_start, window_end, global_entity_id, root_id, campaign_id, campaign_type,
         campaign_start_at_utc AS start_at_utc, campaign_end_at_utc AS end_at_utc FROM roots
  UNION
  SELECT run_date, window_start, window_end, global_entity_id, g_root_id, campaign_id, campaign_type, start_at_utc, end_at_utc
  FROM rc_rows WHERE campaign_id <> root_id
  UNION
  SELECT run_date, window_start, window_end, global_entity_id, root_id, NULL, NULL, NULL, NULL FROM roots WHERE n_children = 0
)"""
CTE["v1_lines"] = """
v1_lines AS (
  SELECT x.*, p.supplier_id, p.global_supplier_id, p.supplier_name, p.product_name, p.brand_name, p.category_level_one, p.barcodes
  FROM (
    SELECT f.run_date, CAST(f.end_at_utc AS DATE) AS campaign_concluded_date_utc, ol.order_id,
      ol.order_date, ol.global_entity_id, ol.country_code,
      CASE ol.global_entity_id WHEN 'AFRICA' THEN 'EGP' WHEN 'AMERICA' THEN 'USD' WHEN 'ASIA' THEN 'JPY' WHEN 'EUROPE' THEN 'EUR'
                               WHEN 'MIDDLE EAST' THEN 'AED' END AS currency_code,
      ol.warehouse_id, ol.platform_vendor_id, ol.campaign_id, f.root_id, ol.sku, ol.quantity_sold,
      CAST(floor(ol.unit_price_listed_lc * 10000) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS unit_price_listed_lc,
      CAST(floor(ol.unit_price_listed_lc * ol.discount_rate * 10000) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS unit_discount_lc,
      CAST(floor(ol.unit_price_listed_lc * (CAST(1 AS DOUBLE) - ol.discount_rate) * 10000) AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS unit_price_paid_lc,
      ol.line_discount_lc, ol.line_total_lc - ol.line_discount_lc AS total_amt_paid_lc,
      CAST(COALESCE(CASE WHEN f.campaign_type = 'SameItemBundle' THEN ol.line_discount_lc ELSE ol.funding_v1_lc END, 0)
           AS DECIMAL(18,2)) AS supplier_funded_amount_lc
    FROM order_lines ol JOIN flat f ON ol.global_entity_id = f.global_entity_id AND ol.campaign_id = f.campaign_id
    WHERE ol.is_successful = TRUE AND ol.quantity_sold > 0 AND ol.campaign_id IS NOT NULL
      AND CAST(f.end_at_utc AS DATE) BETWEEN f.window_start AND f.window_end
      AND ol.order_date >= CAST(f.run_date - INTERVAL 20 MONTH AS DATE)
      AND ol.order_date >= CAST(f.window_start - INTERVAL 18 MONTH AS DATE)) x
  LEFT JOIN products p ON x.global_entity_id = p.global_entity_id AND x.warehouse_id = p.warehouse_id AND x.sku = p.sku
    AND x.platform_vendor_id = p.platform_vendor_id
  WHERE supplier_funded_amount_lc > 0
)"""
CTE["v1_sku"] = """
v1_sku AS (
  SELECT run_date, global_entity_id, country_code, currency_code, supplier_id, global_supplier_id, supplier_name, campaign_concluded_date_utc, root_id, sku,
    product_name, brand_name, category_level_one, barcodes,
    CAST(SUM(unit_price_listed_lc) AS DOUBLE) / COUNT(*) AS avg_unit_price_listed_lc, CAST(SUM(unit_discount_lc) AS DOUBLE) / COUNT(*) AS avg_unit_discount_lc,
    CAST(SUM(unit_price_paid_lc) AS DOUBLE) / COUNT(*) AS avg_unit_price_paid_lc,
    COALESCE(SUM(supplier_funded_amount_lc), 0) AS total_funded_lc, CAST(SUM(quantity_sold) AS BIGINT) AS total_quantity,
    COALESCE(SUM(line_discount_lc), 0) AS total_discount_lc, COALESCE(SUM(total_amt_paid_lc), 0) AS total_amt_paid_lc, COUNT(*) AS n_lines
  FROM v1_lines GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14
)"""

V1_CAMPAIGNS = ["campaign_rows", "campaigns", "entity_campaigns"]
V1_BASE = [*V1_CAMPAIGNS, "v1_run_dates", "windows", "runs", "fc", "rc_rows", "roots"]
V1_LINES = ["entities", "order_lines"] + V1_BASE + ["flat", "pairs", "rep", "offers", "vendors", "supplier_info", "chain_products", "products", "v1_lines"]


def _v1(q: dict[str, str]) -> None:
    q["root_child_campaigns"] = with_ctes(V1_BASE, """
SELECT CAST(run_date AS VARCHAR) AS run_date, CAST(window_start AS VARCHAR) AS window_start,
  CAST(window_end AS VARCHAR) AS window_end, global_entity_id, country_code, campaign_id, root_id, campaign_name, campaign_type, campaign_subtype,
  reason, epoch_us(campaign_created_at_utc) AS campaign_created_at_utc,
  epoch_us(campaign_start_at_utc) AS campaign_start_at_utc, epoch_us(campaign_end_at_utc) AS campaign_end_at_utc,
  n_children, child_ids
FROM roots""")
    q["flatten_union_distinct"] = with_ctes(V1_BASE + ["flat"], """
SELECT CAST(run_date AS VARCHAR) AS run_date, CAST(window_start AS VARCHAR) AS window_start,
  CAST(window_end AS VARCHAR) AS window_end, global_entity_id, root_id, campaign_id, campaign_type,
  epoch_us(start_at_utc) AS start_at_utc, epoch_us(end_at_utc) AS end_at_utc
FROM flat""")
    q["v1_funded_lines"] = with_ctes(V1_LINES, """
SELECT CAST(run_date AS VARCHAR) AS run_date, CAST(campaign_concluded_date_utc AS VARCHAR) AS campaign_concluded_date_utc,
  supplier_id, global_supplier_id, supplier_name, order_id, CAST(order_date AS VARCHAR) AS order_date, global_entity_id, country_code, currency_code,
  warehouse_id, platform_vendor_id, campaign_id, root_id, sku, product_name, brand_name, category_level_one, barcodes, quantity_sold,
  CAST(unit_price_listed_lc AS DOUBLE) AS unit_price_listed_lc, CAST(unit_discount_lc AS DOUBLE) AS unit_discount_lc,
  CAST(unit_price_paid_lc AS DOUBLE) AS unit_price_paid_lc, CAST(line_discount_lc AS DOUBLE) AS line_discount_lc,
  CAST(total_amt_paid_lc AS DOUBLE) AS total_amt_paid_lc, CAST(supplier_funded_amount_lc AS DOUBLE) AS supplier_funded_amount_lc
FROM v1_lines""")
    q["sku_funding"] = with_ctes(V1_LINES + ["v1_sku"], """
SELECT * REPLACE (CAST(run_date AS VARCHAR) AS run_date, CAST(campaign_concluded_date_utc AS VARCHAR) AS campaign_concluded_date_utc,
  CAST(total_funded_lc AS DOUBLE) AS total_funded_lc, CAST(total_discount_lc AS DOUBLE) AS total_discount_lc,
  CAST(total_amt_paid_lc AS DOUBLE) AS total_amt_paid_lc)
FROM v1_sku""")
    q["two_level_statement"] = with_ctes(V1_LINES + ["v1_sku"], """
SELECT CAST(c.run_date AS VARCHAR) AS run_date, c.global_entity_id, c.country_code, c.currency_code, c.supplier_id, c.global_supplier_id, c.supplier_name,
  CAST(r.window_start AS VARCHAR) AS campaign_concluded_week_utc,
  COUNT(*) AS n_campaigns, CAST(SUM(r.n_children) AS BIGINT) AS n_children, CAST(SUM(c.n_skus) AS BIGINT) AS n_sku_rows,
  CAST(SUM(c.campaign_funded_lc) AS DOUBLE) AS total_funded_lc,
  MIN(c.root_id) AS min_root_id, MAX(c.root_id) AS max_root_id, MAX(r.campaign_name) AS max_campaign_name,
  epoch_us(MIN(r.campaign_created_at_utc)) AS first_created_at_utc, MAX(c.max_avg) AS max_avg_unit_price_paid_lc, MAX(c.max_unit) AS max_unit_funding_lc
FROM (SELECT run_date, global_entity_id, country_code, currency_code, supplier_id, global_supplier_id, supplier_name, root_id, COUNT(*) AS n_skus,
        SUM(total_funded_lc) AS campaign_funded_lc, MAX(avg_unit_price_paid_lc) AS max_avg,
        MAX(CAST(total_funded_lc AS DOUBLE) / NULLIF(CAST(total_quantity AS DOUBLE), 0)) AS max_unit
      FROM v1_sku GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) c
JOIN roots r ON c.run_date = r.run_date AND c.global_entity_id = r.global_entity_id AND c.country_code = r.country_code AND c.root_id = r.root_id
GROUP BY c.run_date, c.global_entity_id, c.country_code, c.currency_code, c.supplier_id, c.global_supplier_id, c.supplier_name, r.window_start""")


_EXTRA.append(_v1)


# ----------------------------------------------------------------- quality and monitoring (M1-M6)
def _quality(q: dict[str, str]) -> None:
    q["quality_no_nulls"] = with_ctes(["entities", "order_lines"], """
SELECT 'no_nulls' AS check_name, 'order_lines' AS table_name, target, failing_rows,
  CASE WHEN failing_rows IS NULL THEN 'column_missing' WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (
  SELECT 'order_id' AS target, COUNT(*) FILTER (WHERE order_id IS NULL) AS failing_rows FROM order_lines
  UNION ALL SELECT 'sku', COUNT(*) FILTER (WHERE sku IS NULL) FROM order_lines
  UNION ALL SELECT 'warehouse_id', COUNT(*) FILTER (WHERE warehouse_id IS NULL) FROM order_lines
  UNION ALL SELECT 'campaign_id', COUNT(*) FILTER (WHERE campaign_id IS NULL) FROM order_lines
  UNION ALL SELECT 'funding_v1_lc', COUNT(*) FILTER (WHERE funding_v1_lc IS NULL) FROM order_lines
  UNION ALL SELECT 'created_date_utc', CAST(NULL AS BIGINT)
) x""")
    q["quality_no_duplicates"] = with_ctes(V2_RULES, """
SELECT 'no_duplicates' AS check_name, table_name, target, failing_rows,
  CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (
  SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS target,
    (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d) AS failing_rows
  UNION ALL
  SELECT 'events', 'event_id', (SELECT COUNT(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING COUNT(*) > 1) d)
  UNION ALL
  SELECT 'funding_rules', 'global_entity_id,campaign_id,sku',
    (SELECT COUNT(*) FROM (SELECT 1 FROM t2 GROUP BY global_entity_id, campaign_id, sku HAVING COUNT(*) > 1) d)
) x""")
    q["quality_statement"] = with_ctes(["src_old", "src_new", "src_union"], """
SELECT 'statement_true' AS check_name, table_name, target, CASE WHEN ok THEN 0 ELSE 1 END::BIGINT AS failing_rows,
  CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status
FROM (
  SELECT 'lineitem' AS table_name, 'unique_order_line' AS target,
    (SELECT COUNT(DISTINCT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) = COUNT(*) FROM lineitem) AS ok
  UNION ALL
  SELECT 'merged_events', 'unique_user_props',
    (SELECT COUNT(DISTINCT CAST(user_id AS VARCHAR) || '|' || COALESCE(props, 'null')) = COUNT(*) FROM (
       SELECT user_id, props FROM (
         SELECT u.*, ROW_NUMBER() OVER (PARTITION BY user_id, props ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
         FROM src_union u) w WHERE rn = 1) m)
) x""")
    q["health_report"] = with_ctes(V2_CHAIN, """, m AS (
  SELECT CAST(COUNT(*) AS DOUBLE) AS t4_rows,
    CAST(COUNT(*) FILTER (WHERE funding_total_lc > 0) AS DOUBLE) / COUNT(*) AS funded_share,
    CAST(SUM(COALESCE(funding_v1_lc, 0)) AS DOUBLE) AS v1_sum,
    (CAST(SUM(funding_amount_lc) AS DOUBLE) - CAST(SUM(COALESCE(funding_v1_lc, 0)) AS DOUBLE))
      / CAST(SUM(COALESCE(funding_v1_lc, 0)) AS DOUBLE) * 100.0 AS delta_pct
  FROM t4)
, t5 AS (""" + T5_SELECT + """)
, r AS (
  SELECT 't4_rows' AS metric, t4_rows AS value, 100000000.0 AS threshold FROM m
  UNION ALL SELECT 'funded_share', funded_share, 0.15 FROM m
  UNION ALL SELECT 'v1_sum', v1_sum, 0.0 FROM m
  UNION ALL SELECT 'delta_pct', delta_pct, 50.0 FROM m
  UNION ALL SELECT 't5_rows', CAST((SELECT COUNT(*) FROM t5) AS DOUBLE), 1000.0)
SELECT metric, value, CAST(threshold AS DOUBLE) AS threshold,
  CASE WHEN (metric = 'delta_pct' AND abs(value) > threshold) OR (metric = 'v1_sum' AND value <= threshold)
         OR (metric NOT IN ('delta_pct', 'v1_sum') AND value < threshold) THEN 'alert' ELSE 'ok' END AS status
FROM r""")
    q["coverage_strategy"] = with_ctes(["entities", "order_lines", "config_all"], """
SELECT c.global_entity_id, c.n_lines, c.n_with_campaign, c.coverage_pct,
  CASE WHEN c.coverage_pct > 90 THEN 'campaign_id' WHEN c.coverage_pct >= 50 THEN 'hybrid'
       ELSE 'date_warehouse_sku' END AS suggested_join_strategy,
  cfg.join_strategy AS configured_join_strategy
FROM (SELECT global_entity_id, COUNT(*) AS n_lines, COUNT(campaign_id) AS n_with_campaign,
        CAST(COUNT(campaign_id) AS DOUBLE) * 100.0 / COUNT(*) AS coverage_pct
      FROM order_lines GROUP BY global_entity_id) c
LEFT JOIN config_all cfg ON c.global_entity_id = cfg.global_entity_id""")


_EXTRA.append(_quality)


# ----------------------------------------------------------------- campaigns (L4, L5, L10) and enrichment
SUBTYPE_CASE = _subtype_case()

CTE["raw_c"] = """
raw_c AS (
  SELECT campaign_id, root_id, campaign_name, raw_type AS type, applies_to,
    '{"type": "' || discount_type || '", "value": ' || CAST(discount_value AS VARCHAR) || '}' AS discount,
    CASE WHEN family = 1 THEN (CASE WHEN p_size % 4 = 0 THEN 'ALL' WHEN p_size % 4 = 1 THEN 'NEW_USER'
                                    WHEN p_size % 4 = 2 THEN NULL
                                    ELSE 'seg-' || regexp_extract(campaign_id, '^C\\d-(.*)-\\d+$', 1) END)
         ELSE (CASE WHEN p_size % 3 = 0 THEN 'RETURNING'
                    ELSE 'seg-' || regexp_extract(campaign_id, '^C\\d-(.*)-\\d+$', 1) END) END AS target_audience,
    CAST(start_date AS TIMESTAMP) AS start_time, CAST(end_date AS TIMESTAMP) AS end_time,
    CAST(start_date + CASE WHEN family = 1 AND p_size % 4 = 3 THEN -10 ELSE 5 END AS TIMESTAMP) AS updated_date,
    CASE WHEN family = 1 THEN p_size % 4 <> 3 ELSE p_size % 3 <> 1 END AS active, state, p_partkey
  FROM campaign_rows
)"""
CTE["clean_c"] = """
clean_c AS (
  SELECT *, """ + SUBTYPE_CASE + """ AS campaign_subtype FROM (
    SELECT campaign_id, root_id, campaign_name,
      CASE WHEN type IN ('Generic', 'GENERIC', 'OldFashioned Campaign Type') THEN 'Generic' ELSE type END AS campaign_type,
      applies_to,
      json_extract_string(discount, '$.type') AS discount_type,
      TRY_CAST(json_extract_string(discount, '$.value') AS DOUBLE) AS discount_value,
      CASE WHEN target_audience IS NOT NULL AND target_audience NOT IN ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
           THEN 'SEGMENT_USER' ELSE target_audience END AS target_audience,
      CASE WHEN target_audience IS NOT NULL AND target_audience NOT IN ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
           THEN target_audience END AS target_audience_id,
      start_time AS start_at_utc, end_time AS end_at_utc,
      CASE WHEN updated_date < start_time AND active IS FALSE THEN FALSE ELSE TRUE END AS is_valid, state
    FROM (SELECT r.*, ROW_NUMBER() OVER (PARTITION BY campaign_id ORDER BY updated_date DESC NULLS LAST, p_partkey ASC) AS rn
          FROM raw_c r) x WHERE rn = 1) y
)"""
CTE["ben_merged"] = """
ben_merged AS (
  SELECT campaign_id, sku, supplier_funding_type, supplier_funding_value, is_deleted, src, src_priority FROM (
    SELECT u.*, ROW_NUMBER() OVER (PARTITION BY campaign_id, sku ORDER BY src_priority ASC NULLS LAST) AS rn FROM (
      SELECT campaign_id, sku, supplier_funding_type, supplier_funding_value, is_deleted, 'old' AS src, CAST(2 AS BIGINT) AS src_priority
      FROM benefits
      UNION ALL
      SELECT campaign_id, sku, supplier_funding_type, CAST(supplier_funding_value + 0.50 AS DECIMAL(18,2)), is_deleted, 'new', CAST(1 AS BIGINT)
      FROM benefits WHERE supplier_funding_type = 'ABSOLUTE' AND supplier_funding_value > 0) u) x
  WHERE rn = 1
)"""

CTE["lr"] = """
lr AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS sku, l.l_quantity AS quantity, l.l_discount, p.p_brand, p.p_type, p.p_size,
    ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
          * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2) AS disc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""
CTE["fan"] = """
fan AS (
  SELECT order_id, sku, quantity, 'C1-' || substr(p_brand, 7, 8) || '-' || CAST(p_size % 4 AS VARCHAR) AS campaign_id,
    CASE WHEN p_size % 2 = 0 THEN CAST(ROUND(disc * 0.5, 2) AS DECIMAL(18,2)) END AS promo_funded_lc
  FROM lr WHERE l_discount > 0
  UNION ALL
  SELECT order_id, sku, quantity, 'C2-' || p_type || '-' || CAST(p_size % 3 AS VARCHAR), CAST(NULL AS DECIMAL(18,2))
  FROM lr WHERE sku % 2 = 0
  UNION ALL
  SELECT order_id, sku, quantity, NULL, CAST(NULL AS DECIMAL(18,2)) FROM lr WHERE NOT (l_discount > 0) AND sku % 2 <> 0
)"""

def _campaign_layer(q: dict[str, str]) -> None:
    q["campaign_subtype"] = with_ctes(["campaign_rows", "raw_c", "clean_c"], """
SELECT campaign_id, root_id, campaign_name, campaign_type, campaign_subtype, applies_to, discount_type, discount_value,
  epoch_us(start_at_utc) AS start_at_utc, epoch_us(end_at_utc) AS end_at_utc, is_valid, state
FROM clean_c""")
    q["audience_split"] = with_ctes(["campaign_rows", "raw_c", "clean_c"], """
SELECT campaign_id, target_audience, target_audience_id, is_valid FROM clean_c""")
    q["benefits_priority"] = with_ctes(["campaign_rows", "benefits", "ben_merged"], """
SELECT campaign_id, sku, supplier_funding_type, CAST(supplier_funding_value AS DOUBLE) AS supplier_funding_value,
  is_deleted, src, src_priority FROM ben_merged""")
    q["nested_campaigns"] = with_ctes(["campaign_rows", "raw_c", "clean_c", "benefits", "ben_merged"], """
SELECT c.campaign_id, COALESCE(b.n_benefits, 0) AS n_benefits, COALESCE(b.n_new_source, 0) AS n_new_source,
  CAST(COALESCE(b.sum_funding_value, 0) AS DOUBLE) AS sum_funding_value
FROM clean_c c LEFT JOIN (
  SELECT campaign_id, COUNT(*) AS n_benefits, COUNT(*) FILTER (WHERE src = 'new') AS n_new_source,
    SUM(COALESCE(supplier_funding_value, 0)) AS sum_funding_value
  FROM ben_merged WHERE is_deleted = FALSE GROUP BY campaign_id) b ON c.campaign_id = b.campaign_id""")
    q["entity_regex_exclusion"] = """
SELECT n.n_name, COUNT(*) AS n_lines,
  COUNT(*) FILTER (WHERE n.n_name <> 'NATION_3' OR NOT regexp_matches(lower(p.p_name), 'ring|widget')) AS n_kept
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name"""
    q["order_value_breakdown"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
  l_extendedprice / l_quantity AS unit_price_listed_lc,
  (l_extendedprice * (1.0 - rate)) / l_quantity AS unit_price_paid_lc,
  GREATEST(l_extendedprice / l_quantity - (l_extendedprice * (1.0 - rate)) / l_quantity, 0.0) AS unit_discount_lc,
  CAST(CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS DOUBLE) AS vat_pct,
  CAST(paid AS DOUBLE) AS total_amt_paid_lc,
  CAST(paid AS DOUBLE) / (1.0 + l_tax) AS net_sales_lc,
  CAST(paid AS DOUBLE) / (1.0 + CAST(s_nationkey AS DOUBLE) * 0.125) AS total_amt_paid_eur,
  CASE WHEN p_size > 40 THEN l_quantity / NULLIF(CAST(p_size % 7 AS DOUBLE), 0) END AS weight_units,
  CAST(CAST(wac * (CAST(l_quantity AS BIGINT) - CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
       * CASE WHEN p_size > 40 THEN 1000 ELSE 1 END AS DECIMAL(38,4)) AS DOUBLE) AS cogs_lc,
  CAST(paid AS DOUBLE) / (1.0 + l_tax) - CAST(wac * CAST(l_quantity AS BIGINT) AS DOUBLE)
    + CAST(COALESCE(CASE WHEN p_size % 2 = 0 THEN CAST(ROUND(disc * 0.5, 2) AS DECIMAL(18,2)) END, 0) AS DOUBLE) AS ppp_lc
FROM (
  SELECT l.*, p.p_size, s.s_nationkey,
    CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS rate,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS disc,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) - CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS paid,
    CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * 0.60 AS DECIMAL(18,4)) AS wac
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey) x"""
    q["line_campaign_rollup"] = with_ctes(["lr", "fan"], """
, ext AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS sku,
    'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) AS campaign_id,
    CAST(ROUND(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2) * 0.8, 2) AS DECIMAL(18,2)) AS external_funded_lc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'R' AND l.l_discount > 0)
SELECT f.order_id, f.sku,
  CAST(COALESCE(SUM(e.external_funded_lc), SUM(f.promo_funded_lc), 0) AS DOUBLE) AS funded_lc,
  SUM(f.quantity) AS quantity_sum, COUNT(f.campaign_id) AS n_campaign_rows,
  array_to_string(list_sort(list_distinct(list(f.campaign_id))), ',') AS campaign_ids,
  CAST(MAX(COALESCE(e.external_funded_lc, f.promo_funded_lc)) AS DOUBLE) AS max_campaign_funded_lc
FROM fan f LEFT JOIN ext e ON f.order_id = e.order_id AND f.sku = e.sku AND f.campaign_id = e.campaign_id
GROUP BY f.order_id, f.sku""")
    q["shared_view"] = with_ctes(["entities", "config_all", "config"], """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, e.global_entity_id
FROM customer c JOIN entities e ON c.c_custkey = e.c_custkey
WHERE e.global_entity_id IN (SELECT global_entity_id FROM config)""")


_EXTRA.append(_campaign_layer)


# ----------------------------------------------------------------- refresh and streaming
def _refresh(q: dict[str, str]) -> None:
    q["incremental_equals_full"] = with_ctes(["entities"], """
SELECT o.o_orderkey AS order_id, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
  CAST(CAST(date_trunc('month', o.o_orderdate) AS DATE) AS VARCHAR) AS order_month, e.global_entity_id,
  'W' || CAST(o.o_custkey % 5 AS VARCHAR) AS warehouse_id, o.o_totalprice
FROM orders o JOIN entities e ON o.o_custkey = e.c_custkey""")
    q["two_speed_refresh"] = q["incremental_equals_full"]
    q["stream_latest_per_key"] = """
SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM (
  SELECT e.*, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
  FROM events e) x WHERE rn = 1"""


_EXTRA.append(_refresh)


# ----------------------------------------------------------------- vendors, triggers, combo rows, old benefits
CTE["raw_t"] = """
raw_t AS (
  SELECT campaign_id, p_partkey AS product_id, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey END AS sku,
    p_partkey % 10 AS vendor_id, CAST(start_date + p_size AS TIMESTAMP) AS modified_at, p_size
  FROM campaign_rows WHERE family = 1
)"""
CTE["trig"] = """
trig AS (
  SELECT DISTINCT campaign_id, COALESCE(sku, product_id) AS sku, vendor_id FROM (
    SELECT r.*, ROW_NUMBER() OVER (PARTITION BY campaign_id, product_id ORDER BY modified_at DESC NULLS LAST, vendor_id ASC) AS rn
    FROM (SELECT campaign_id, product_id, sku, vendor_id, modified_at FROM raw_t
          UNION ALL
          SELECT campaign_id, product_id, sku, (vendor_id + 1) % 10, modified_at + INTERVAL 1 DAY FROM raw_t WHERE p_size > 25) r
  ) x WHERE rn = 1
)"""


def _vendors(q: dict[str, str]) -> None:
    q["clean_vendors"] = """
SELECT vendor_id, n_name, platform_code_a, platform_code_b, is_key_vendor,
  is_key_vendor IS NOT DISTINCT FROM FALSE AS is_key_vendor_false, has_name FROM (
  SELECT s.s_suppkey AS vendor_id, n.n_name,
    CASE WHEN n.n_name LIKE 'NATION_1%' THEN s.s_name END AS platform_code_a,
    CASE WHEN NOT (n.n_name LIKE 'NATION_1%') THEN s.s_name END AS platform_code_b,
    (s.s_acctbal > 9000) OR (n.n_name IN ('NATION_2', 'NATION_4')
      AND CASE WHEN s.s_suppkey % 3 = 0 THEN NULL ELSE s.s_acctbal > 0 END) AS is_key_vendor,
    NULLIF(s.s_name, '') IS NOT NULL AS has_name
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) x"""
    q["campaign_triggers"] = with_ctes(["campaign_rows", "raw_t", "trig"], "SELECT campaign_id, sku, vendor_id FROM trig")
    q["campaign_vendors"] = with_ctes(["campaign_rows", "raw_t", "trig"], """
SELECT campaign_id, vendor_id, COUNT(*) AS n_skus FROM trig GROUP BY campaign_id, vendor_id""")
    q["order_campaign_combo"] = """
SELECT l.l_orderkey AS order_id, CAST(NULL AS BIGINT) AS parent_product_id, l.l_partkey AS product_id, FALSE AS is_combo_product
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
UNION ALL
SELECT l.l_orderkey, l.l_partkey, l.l_partkey + 1, TRUE FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size > 45
UNION ALL
SELECT l.l_orderkey, l.l_partkey, l.l_partkey + 2, TRUE FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size > 45"""
    q["old_benefits"] = with_ctes(["campaign_rows"], """
SELECT campaign_id, sku, epoch_us(created_at) AS created_at, epoch_us(updated_at) AS updated_at, discount FROM (
  SELECT a.*, ROW_NUMBER() OVER (PARTITION BY campaign_id, sku ORDER BY updated_at DESC NULLS LAST, created_at DESC) AS rn FROM (
    SELECT campaign_id, p_partkey AS sku,
      COALESCE(CASE WHEN p_size % 6 = 0 THEN NULL ELSE CAST(start_date - 3 AS TIMESTAMP) END,
               CAST(start_date + p_size AS TIMESTAMP)) AS created_at,
      CAST(start_date + p_size AS TIMESTAMP) AS updated_at, p_retailprice * 0.1 AS discount
    FROM campaign_rows) a) b WHERE rn = 1""")


_EXTRA.append(_vendors)


# ----------------------------------------------------------------- curated orders (L16) and catalogue
CTE["ext2"] = """
ext2 AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS sku,
    'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) AS campaign_id,
    CAST(ROUND(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2) * 0.8, 2) AS DECIMAL(18,2)) AS external_funded_lc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'R' AND l.l_discount > 0
)"""
CTE["rollup"] = """
rollup AS (
  SELECT f.order_id, f.sku, COALESCE(SUM(e.external_funded_lc), SUM(f.promo_funded_lc), 0) AS funded_lc
  FROM fan f LEFT JOIN ext2 e ON f.order_id = e.order_id AND f.sku = e.sku AND f.campaign_id = e.campaign_id
  GROUP BY f.order_id, f.sku
)"""
CTE["wh"] = """
wh AS (SELECT DISTINCT warehouse_id, warehouse_id IN ('W1', 'W3') AS ext_listing,
         'Warehouse ' || substr(warehouse_id, 2, 8) AS wname FROM offers)"""
CTE["vp"] = """
vp AS (
  SELECT o.sku, o.supplier_id, o.warehouse_id, o.origin, w.wname,
    CASE WHEN o.warehouse_id = 'W4'
         THEN COALESCE(CASE WHEN o.supplier_id % 3 = 0 THEN NULL ELSE o.supplier_id % 7 END,
                       CASE WHEN o.supplier_id % 2 = 0 THEN NULL ELSE o.supplier_id % 5 END, 0)
         ELSE COALESCE(CASE WHEN o.supplier_id % 2 = 0 THEN NULL ELSE o.supplier_id % 5 END, 0) END AS stock,
    len(string_split(p.p_name, ' ')) AS n_details
  FROM offers o LEFT JOIN wh w ON o.warehouse_id = w.warehouse_id AND NOT w.ext_listing
  JOIN part p ON o.sku = p.p_partkey
)"""


def _curated2(q: dict[str, str]) -> None:
    q["curated_orders"] = with_ctes(["entities", "lr", "fan", "ext2", "rollup"], """
SELECT o.o_orderkey AS order_id, e.global_entity_id, e.country_code,
  CASE WHEN e.global_entity_id = 'ASIA' AND e.country_code = 'as' AND o.o_orderdate >= TIMESTAMP '1998-06-01 10:36:00'
       THEN 'N-' ELSE 'O-' END || CAST(o.o_orderkey AS VARCHAR) AS platform_order_code,
  COALESCE(i.n_items, 0) AS n_items, CAST(COALESCE(i.v, 0) AS DOUBLE) AS order_value_lc,
  CAST(COALESCE(i.v, 0) AS DOUBLE) / (1.0 + CAST(c.c_nationkey AS DOUBLE) * 0.125) AS order_value_eur,
  CAST(COALESCE(fu.funded, 0) AS DOUBLE) AS funded_lc
FROM orders o JOIN entities e ON o.o_custkey = e.c_custkey JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (
  SELECT l_orderkey, COUNT(*) AS n_items, SUM(CAST(t - ROUND(t * r, 2) AS DECIMAL(18,2))) AS v FROM (
    SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS t,
      CAST(CASE WHEN l_discount > 0 THEN l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)) AS r FROM lineitem) x
  GROUP BY l_orderkey) i ON o.o_orderkey = i.l_orderkey
LEFT JOIN (SELECT order_id, SUM(funded_lc) AS funded FROM rollup GROUP BY order_id) fu ON o.o_orderkey = fu.order_id""")
    q["nested_catalogue"] = with_ctes(["pairs", "rep", "offers", "wh", "vp"], """
SELECT p.p_partkey AS sku, COUNT(vp.sku) AS n_vendor_products, CAST(COALESCE(SUM(vp.n_details), 0) AS BIGINT) AS n_category_details,
  COALESCE(bool_or(vp.origin = 'direct'), FALSE) AS has_own_store_offer, CAST(COALESCE(SUM(vp.stock), 0) AS BIGINT) AS total_stock,
  COUNT(vp.wname) AS n_named_warehouses,
  'B' || CAST(p.p_partkey AS VARCHAR) || '-1,B' || CAST(p.p_partkey AS VARCHAR) || '-2' AS barcode_list,
  (p.p_brand = 'Brand#1') OR (p.p_type IN ('PROMO', 'SMALL') AND COALESCE(bool_or(vp.origin = 'direct'), FALSE)) AS is_featured_product
FROM part p LEFT JOIN vp ON p.p_partkey = vp.sku
GROUP BY p.p_partkey, p.p_brand, p.p_type""")


_EXTRA.append(_curated2)


# ----------------------------------------------------------------- order-line enrichment by histories
def _enrich(q: dict[str, str]) -> None:
    q["order_line_enrichment"] = """
WITH lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS sku, l.l_suppkey AS supplier_id, o.o_orderdate AS order_ts,
    CAST(o.o_orderdate AS DATE) AS order_date, CAST(l.l_shipdate AS DATE) AS ship_date,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2))
         - ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
                 * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2)
         AS DECIMAL(18,2)) AS paid_lc
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
vat AS (
  SELECT sku, valid_from, vat_pct,
    COALESCE(LEAD(valid_from) OVER (PARTITION BY sku ORDER BY valid_from), DATE '9999-12-31') AS valid_to
  FROM (SELECT p_partkey AS sku, DATE '1995-01-01' AS valid_from, (p_size % 3) * 5 AS vat_pct FROM part
        UNION ALL
        SELECT p_partkey, DATE '1998-01-01' + CAST(p_partkey % 365 AS INTEGER), (p_size % 3) * 5 + 1 FROM part) v),
wh AS (
  SELECT supplier_id, warehouse_id, migrated_at,
    COALESCE(LAG(migrated_at) OVER (PARTITION BY supplier_id ORDER BY migrated_at DESC NULLS LAST),
             TIMESTAMP '1970-01-01 00:00:00') AS valid_from,
    COALESCE(migrated_at, TIMESTAMP '2030-01-01 00:00:00') AS valid_to
  FROM (SELECT s_suppkey AS supplier_id, 'W' || CAST(s_suppkey % 5 AS VARCHAR) AS warehouse_id,
               CAST(NULL AS TIMESTAMP) AS migrated_at FROM supplier
        UNION ALL
        SELECT s_suppkey, 'W' || CAST((s_suppkey + 1) % 5 AS VARCHAR),
               CAST(DATE '1997-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS TIMESTAMP) FROM supplier
        UNION ALL
        SELECT s_suppkey, 'W' || CAST((s_suppkey + 2) % 5 AS VARCHAR),
               CAST(DATE '1996-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS TIMESTAMP) FROM supplier) w),
fx AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS fx_date,
    1.0 + CAST(dayofyear(CAST(o_orderdate AS DATE)) % 8 AS DOUBLE) * 0.125 AS fx_rate
  FROM orders)
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.sku, l.supplier_id,
  CAST(l.order_date AS VARCHAR) AS order_date, CAST(l.ship_date AS VARCHAR) AS ship_date,
  CAST(v.vat_pct AS BIGINT) AS vat_pct, w.warehouse_id AS wh_warehouse_id,
  epoch_us(w.valid_from) AS wh_valid_from, epoch_us(w.valid_to) AS wh_valid_to,
  CAST(l.paid_lc AS DOUBLE) AS paid_lc,
  CAST(l.paid_lc AS DOUBLE) / (1.0 + CAST(v.vat_pct AS DOUBLE) / 100.0) AS net_sales_lc,
  f.fx_rate, CAST(l.paid_lc AS DOUBLE) / f.fx_rate AS total_amt_paid_eur
FROM lines l
LEFT JOIN vat v ON l.sku = v.sku AND l.order_date >= v.valid_from AND l.order_date < v.valid_to
LEFT JOIN wh w ON l.supplier_id = w.supplier_id AND l.order_ts >= w.valid_from AND l.order_ts <= w.valid_to
LEFT JOIN fx f ON l.ship_date = f.fx_date"""


_EXTRA.append(_enrich)


# ----------------------------------------------------------------- two-level nesting (E8 x2, D18 x2)
def _two_level(q: dict[str, str]) -> None:
    q["unnest_two_levels"] = """
WITH li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS sku, l.l_discount, p.p_brand, p.p_type, p.p_size,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2))
               * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE CAST(0.0 AS DOUBLE) END AS DECIMAL(4,2)), 2)
         AS DECIMAL(18,2)) AS disc,
    ROW_NUMBER() OVER (PARTITION BY l.l_orderkey
                       ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_discount) - 1 AS item_pos
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
x AS (
  SELECT l_orderkey, item_pos, l_linenumber, sku, 0 AS ci_pos,
    'C1-' || substr(p_brand, 7, 8) || '-' || CAST(p_size % 4 AS VARCHAR) AS campaign_id, disc AS discount_lc
  FROM li WHERE l_discount > 0
  UNION ALL
  SELECT l_orderkey, item_pos, l_linenumber, sku, CASE WHEN l_discount > 0 THEN 1 ELSE 0 END,
    'C2-' || p_type || '-' || CAST(p_size % 3 AS VARCHAR), CAST(NULL AS DECIMAL(18,2))
  FROM li WHERE sku % 2 = 0
  UNION ALL
  SELECT l_orderkey, item_pos, l_linenumber, sku, NULL, NULL, CAST(NULL AS DECIMAL(18,2))
  FROM li WHERE NOT (l_discount > 0) AND sku % 2 <> 0)
SELECT o.o_orderkey AS order_id, x.item_pos, CAST(x.l_linenumber AS BIGINT) AS l_linenumber, x.sku,
  CAST(x.ci_pos AS BIGINT) AS ci_pos, x.campaign_id, CAST(x.discount_lc AS DOUBLE) AS discount_lc
FROM orders o LEFT JOIN x ON o.o_orderkey = x.l_orderkey"""


_EXTRA.append(_two_level)


def _dup_charges(q: dict[str, str]) -> None:
    q["duplicate_charge_check"] = with_ctes(V1_LINES, """
SELECT CAST(run_date AS VARCHAR) AS run_date, COUNT(*) AS n_duplicate_keys,
  CAST(SUM(n - 1) AS BIGINT) AS n_extra_charges, CAST(SUM(amount) AS DOUBLE) AS duplicate_key_amount_lc
FROM (SELECT run_date, order_id, sku, COUNT(*) AS n, SUM(supplier_funded_amount_lc) AS amount
      FROM v1_lines GROUP BY run_date, order_id, sku HAVING COUNT(*) > 1) d
GROUP BY run_date""")


_EXTRA.append(_dup_charges)


# ----------------------------------------------------------------- product histories
CTE["vat_hist"] = """
vat_hist AS (
  SELECT sku, vat_pct, valid_from, COALESCE(LEAD(valid_from) OVER (PARTITION BY sku ORDER BY valid_from), DATE '9999-12-31') AS valid_to
  FROM (SELECT p_partkey AS sku, DATE '1995-01-01' AS valid_from, (p_size % 3) * 5 AS vat_pct FROM part
        UNION ALL SELECT p_partkey, DATE '1998-01-01' + CAST(p_partkey % 365 AS INTEGER), (p_size % 3) * 5 + 1 FROM part) x
)"""
CTE["cost_hist"] = """
cost_hist AS (
  SELECT sku, unit_cost, valid_from, COALESCE(LEAD(valid_from) OVER (PARTITION BY sku ORDER BY valid_from), DATE '9999-12-31') AS valid_to
  FROM (SELECT l_partkey AS sku, CAST(date_trunc('month', l_shipdate) AS DATE) AS valid_from,
          MIN(l_extendedprice / l_quantity) * CAST(0.6 AS DOUBLE) AS unit_cost FROM lineitem GROUP BY 1, 2) x
)"""
CTE["buffer_hist"] = """
buffer_hist AS (
  SELECT p_partkey AS sku, DATE '1995-01-01' AS valid_from, DATE '1997-01-01' + CAST(p_partkey % 200 AS INTEGER) AS valid_to,
    p_size % 4 AS sales_buffer FROM part
  UNION ALL
  SELECT p_partkey, DATE '1997-01-01' + CAST(p_partkey % 200 AS INTEGER), DATE '2000-01-01' + CAST(p_partkey % 100 AS INTEGER), (p_size + 1) % 4 FROM part
  UNION ALL
  SELECT p_partkey, DATE '2000-01-01' + CAST(p_partkey % 100 AS INTEGER),
    CASE WHEN p_partkey % 3 = 0 THEN DATE '2001-01-01' ELSE DATE '9999-12-31' END, (p_size + 2) % 4 FROM part
)"""
CTE["attr_hist"] = """
attr_days AS (
  SELECT p_partkey AS sku, p_size, DATE '1996-01-01' + CAST(p_partkey % 50 AS INTEGER) AS day1,
    DATE '1999-06-01' + CAST(p_partkey % 30 AS INTEGER) AS day2,
    CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END AS even, CASE WHEN p_partkey % 3 = 0 THEN 'true' ELSE 'false' END AS third
  FROM part WHERE p_size > 20),
attr_updates AS (
  SELECT sku, 'sold_by_weight' AS field, day1 AS d, 8 AS h, 'false' AS v FROM attr_days
  UNION ALL SELECT sku, 'sold_by_weight', day1, 17, even FROM attr_days
  UNION ALL SELECT sku, 'sold_by_weight', day2, 9, third FROM attr_days
  UNION ALL SELECT sku, 'sold_by_piece', day1, 8, 'true' FROM attr_days
  UNION ALL SELECT sku, 'sold_by_piece', day1, 18, third FROM attr_days
  UNION ALL SELECT sku, 'sold_by_piece', day2, 7, 'false' FROM attr_days
  UNION ALL SELECT sku, 'minimum_starting_weight', day1, 6, '1' FROM attr_days
  UNION ALL SELECT sku, 'minimum_starting_weight', day1, 12, CAST(p_size * CAST(0.5 AS DOUBLE) AS VARCHAR) FROM attr_days
  UNION ALL SELECT sku, 'average_weight_per_piece', day1, 8, '1' FROM attr_days
  UNION ALL SELECT sku, 'average_weight_per_piece', day1, 9, CASE WHEN sku % 7 = 0 THEN 'n/a' ELSE CAST(p_size * 25 AS VARCHAR) END FROM attr_days
  UNION ALL SELECT sku, 'average_weight_per_piece', day2, 9, '500' FROM attr_days),
attr_hist AS (
  SELECT sku, field, v, d AS valid_from, COALESCE(LEAD(d) OVER (PARTITION BY sku, field ORDER BY d), DATE '9999-12-31') AS valid_to
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku, field, d ORDER BY h DESC) AS rn FROM attr_updates) x WHERE rn = 1
)"""


def _histories(q: dict[str, str]) -> None:
    def meets(alias, extra=""):
        return f"ON l.l_partkey = {alias}.sku AND l.d >= {alias}.valid_from AND l.d < {alias}.valid_to{extra}"

    attrs = "\n".join(f"  LEFT JOIN attr_hist {a} {meets(a, f" AND {a}.field = '{f}'")}" for a, f in (
        ("sbw", "sold_by_weight"), ("sbp", "sold_by_piece"), ("msw", "minimum_starting_weight"), ("awp", "average_weight_per_piece")))
    q["order_line_histories"] = with_ctes(["hist", "vat_hist", "cost_hist", "buffer_hist", "attr_hist"], f"""
SELECT order_id, l_linenumber, sku, CAST(d AS VARCHAR) AS order_date, quantity_ordered,
  COALESCE(delivered, 0.0)::DOUBLE AS quantity_delivered, COALESCE(returned, 0.0)::DOUBLE AS quantity_returned, kept AS quantity_sold,
  vat AS product_vat_rate, sales_buffer, listed AS unit_price_listed_lc,
  CASE WHEN listed - unit_paid > 0 THEN listed - unit_paid ELSE CAST(0 AS DOUBLE) END AS unit_discount_lc,
  COALESCE(unit_cost, unit_price) AS unit_cost_lc,
  CASE WHEN by_weight OR by_piece THEN COALESCE(unit_cost, CAST(0 AS DOUBLE)) * kept * 1000 ELSE COALESCE(unit_cost, CAST(0 AS DOUBLE)) * kept END AS amt_cogs_lc,
  net AS total_amt_paid_net_lc, net - COALESCE(unit_cost, CAST(0 AS DOUBLE)) * delivered AS total_ppp_lc,
  weightable AS is_weightable, CASE WHEN weightable THEN quantity_ordered END AS ordered_weight, CASE WHEN weightable THEN delivered END AS delivered_weight,
  CASE WHEN weightable THEN kept END AS sold_weight, CASE WHEN weightable THEN returned END AS returned_weight,
  CASE WHEN weightable THEN 'KG' END AS weight_unit, minimum_starting_weight, average_weight_per_piece
FROM (
  SELECT *, paid / (CAST(1 AS DOUBLE) + vat / 100) AS net, COALESCE(delivered - COALESCE(returned, CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) AS kept,
    COALESCE(by_weight, FALSE) OR COALESCE(by_piece, FALSE) AS weightable
  FROM (
    SELECT l.l_orderkey AS order_id, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey AS sku, l.d, l.l_quantity AS quantity_ordered,
      CASE WHEN l.l_linestatus = 'O' AND l.l_linenumber % 5 = 0 THEN NULL ELSE l.l_quantity END AS delivered,
      CASE WHEN l.l_returnflag = 'R' THEN floor(l.l_quantity / 2) WHEN l.l_returnflag = 'A' THEN CAST(0 AS DOUBLE) END AS returned,
      l.l_extendedprice / l.l_quantity AS unit_price, l.paid / l.l_quantity AS unit_paid, l.paid,
      COALESCE(CAST(vat.vat_pct AS DOUBLE), l.l_tax * 100, CAST(0 AS DOUBLE)) AS vat, CAST(buf.sales_buffer AS BIGINT) AS sales_buffer,
      COALESCE(pr.unit_price, l.l_extendedprice / l.l_quantity, CAST(0 AS DOUBLE)) AS listed, co.unit_cost,
      CAST(sbw.v AS BOOLEAN) AS by_weight, CAST(sbp.v AS BOOLEAN) AS by_piece, CAST(msw.v AS DOUBLE) AS minimum_starting_weight,
      TRY_CAST(awp.v AS DOUBLE) AS average_weight_per_piece
    FROM (SELECT l.*, CAST(o.o_orderdate AS DATE) AS d,
            l_extendedprice * (CAST(1 AS DOUBLE) - CASE WHEN l_discount > 0 THEN l_discount ELSE CAST(0 AS DOUBLE) END) AS paid
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) l
  LEFT JOIN hist pr {meets("pr")}
  LEFT JOIN vat_hist vat {meets("vat")}
  LEFT JOIN cost_hist co {meets("co")}
  LEFT JOIN buffer_hist buf {meets("buf")}
{attrs}) x) y""")
    q["latest_row_per_day"] = """
SELECT user_id, CAST(event_date AS VARCHAR) AS event_date, event_id, epoch_us(ts) AS ts, event_type, value, props FROM (
  SELECT *, CAST(ts AS DATE) AS event_date,
    ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) x
WHERE rn = 1"""


_EXTRA.append(_histories)


# ----------------------------------------------------------------- two-generation merges, products, nested orders, local days
CTE["promo_rows"] = """
promo_rows AS (
  SELECT e.country_code, e.global_entity_id, l.l_orderkey AS order_id, 'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) AS campaign_id,
    CASE WHEN l.l_partkey % 11 <> 0 THEN l.l_partkey END AS product_id, CASE WHEN p.p_size > 45 THEN l.l_partkey - 1 END AS parent_product_id,
    l.l_linenumber, p.p_size, l.l_quantity AS product_qty, l.l_returnflag AS flag, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS total,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(greatest(l.l_discount, CAST(0 AS DOUBLE)) AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS discount_lc,
    o.o_orderdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN entities e ON o.o_custkey = e.c_custkey JOIN part p ON l.l_partkey = p.p_partkey),
cart AS (
  SELECT country_code, global_entity_id, order_id, campaign_id, product_id, parent_product_id, parent_product_id IS NOT NULL AS is_combo_product,
    product_qty, total, CAST(discount_lc - again * 0.01 AS DECIMAL(18,2)) AS discount_lc,
    CASE WHEN p_size % 2 = 0 THEN CAST(ROUND(discount_lc * 0.5, 2) AS DECIMAL(18,2)) END AS supplier_funded_amount,
    CASE WHEN flag <> 'N' THEN CAST(p_size % 3 AS BIGINT) END AS benefit_qty, CASE WHEN p_size % 10 = 0 THEN 'brand' END AS external_funder,
    o_orderdate + to_hours(CAST(l_linenumber + 24 * again AS INTEGER)) AS created_at
  FROM promo_rows, (VALUES (0), (1)) v(again) WHERE l_linenumber % 2 = 1 AND (again = 0 OR p_size % 5 = 0)),
app AS (
  SELECT *, o_orderdate + to_hours(CAST(l_linenumber % 4 AS INTEGER)) AS created_at FROM promo_rows WHERE l_linenumber % 3 = 0
)"""


def _merge_sql(keys, cart_only, both):
    keyed = ", ".join(keys)
    on = " AND ".join([f"w.{k} = {{a}}.{k}" for k in keys] + ["w.created_at = {a}.created_at"])
    cols = [f"c.{x} AS {x}" for x in cart_only] + [f"COALESCE(c.{x}, a.{x}) AS {x}" for x in both]
    return f"""
SELECT {", ".join("w." + k for k in keys)}, epoch_us(w.created_at) AS created_at, {", ".join(cols)},
  CASE WHEN c.order_id IS NOT NULL THEN 'cart' WHEN a.order_id IS NOT NULL THEN 'app' END AS src
FROM (SELECT {keyed}, created_at FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {keyed} ORDER BY created_at DESC) AS rn
    FROM (SELECT {keyed}, created_at FROM cart UNION ALL SELECT {keyed}, created_at FROM app) u) x WHERE rn = 1) w
LEFT JOIN cart c ON {on.format(a="c")}
LEFT JOIN app a ON {on.format(a="a")}"""


CTE["chain_products"] = """
chain_rows AS (
  SELECT v.global_entity_id, lower(substr(v.global_entity_id, 1, 2)) AS country_code, p.sku, v.vendor_id, v.warehouse_id, pt.p_name, pt.p_brand, pt.p_type, ch.chain,
    CASE WHEN p.sku % 10 = 0 AND ch.chain = 0 THEN NULL ELSE DATE '2000-01-01' + CAST(p.sku % 100 + ch.chain * 30 AS INTEGER) END AS created
  FROM (SELECT DISTINCT pr.sku, s.s_nationkey, s.s_suppkey % 10 AS k FROM pairs pr JOIN supplier s ON pr.supplier_id = s.s_suppkey) p
  JOIN vendors v ON v.n_nationkey = p.s_nationkey AND v.k = p.k
  JOIN part pt ON p.sku = pt.p_partkey
  JOIN (VALUES (0), (1)) ch(chain) ON ch.chain = 0 OR p.sku % 4 = 0
  WHERE v.warehouse_id <> ''),
chain_products AS (
  SELECT * FROM (
    SELECT c.*, p_name || CASE WHEN chain = 1 THEN ' new' ELSE '' END AS product_name, cat.category,
      ROW_NUMBER() OVER (PARTITION BY global_entity_id, sku, warehouse_id, vendor_id
        ORDER BY created DESC NULLS LAST, p_name || CASE WHEN chain = 1 THEN ' new' ELSE '' END, cat.category NULLS LAST) AS rn
    FROM chain_rows c LEFT JOIN LATERAL (SELECT unnest(CASE WHEN c.sku % 9 <> 0 THEN [c.p_type, c.p_brand] END) AS category) cat ON TRUE) x
  WHERE rn = 1
)"""

CTE["products"] = """
products AS (
SELECT DISTINCT c.global_entity_id, c.country_code, si.supplier_id, a.gsid AS global_supplier_id, a.s_name AS supplier_name, c.sku, c.product_name,
  c.p_brand AS brand_name, c.category AS category_level_one,
  CASE c.country_code WHEN 'am' THEN 'B' || c.sku || '-0,' ELSE '' END || CASE c.country_code WHEN 'as' THEN 'B' || c.sku || '-1,' ELSE '' END
    || 'B' || c.sku || '-2' || CASE c.country_code WHEN 'eu' THEN ',B' || c.sku || '-3' ELSE '' END AS barcodes,
  c.warehouse_id, c.vendor_id AS platform_vendor_id, c.created AS chain_product_created_at
FROM chain_products c
LEFT JOIN supplier_info si ON c.global_entity_id = si.global_entity_id AND c.sku = si.sku AND c.warehouse_id = si.warehouse_id
LEFT JOIN (SELECT r_name AS ge, s_name, 'G' || s_suppkey AS gsid, CAST(s_suppkey AS VARCHAR) AS portal_id
           FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 6 <> 0) a
  ON c.global_entity_id = a.ge AND CAST(si.supplier_id AS VARCHAR) = a.portal_id
)"""

CTE["day_lines"] = """
day_lines AS (
  SELECT * EXCLUDE (local_day, order_date), k.day_kind, CASE WHEN k.day_kind = 'utc' THEN order_date ELSE local_day END AS order_date
  FROM (
    SELECT ol.*, CAST(timezone(CASE global_entity_id WHEN 'AFRICA' THEN 'Africa/Cairo' WHEN 'AMERICA' THEN 'America/New_York' WHEN 'ASIA' THEN 'Asia/Tokyo'
                                 WHEN 'EUROPE' THEN 'Europe/Berlin' WHEN 'MIDDLE EAST' THEN 'Asia/Dubai' END,
                               timezone('UTC', CAST(order_date AS TIMESTAMP) + to_seconds((order_id * 7919) % 86400))) AS DATE) AS local_day
    FROM order_lines ol) x, (VALUES ('utc'), ('local')) k(day_kind)
  WHERE local_day <> order_date
)"""


def _merges(q: dict[str, str]) -> None:
    q["order_campaign_merge"] = with_ctes(["entities", "promo_rows"], _merge_sql(
        ["country_code", "order_id", "campaign_id", "product_id"],
        ["parent_product_id", "is_combo_product", "supplier_funded_amount::DOUBLE", "benefit_qty", "external_funder"],
        ["global_entity_id", "discount_lc::DOUBLE"]).replace("::DOUBLE AS supplier_funded_amount::DOUBLE", "::DOUBLE AS supplier_funded_amount")
        .replace("COALESCE(c.discount_lc::DOUBLE, a.discount_lc::DOUBLE) AS discount_lc::DOUBLE", "CAST(COALESCE(c.discount_lc, a.discount_lc) AS DOUBLE) AS discount_lc"))
    q["order_item_merge"] = with_ctes(["entities", "promo_rows"], _merge_sql(
        ["country_code", "order_id", "product_id"], ["parent_product_id", "is_combo_product"], ["global_entity_id", "product_qty", "total", "discount_lc"])
        .replace("COALESCE(c.total, a.total) AS total", "CAST(COALESCE(c.total, a.total) AS DOUBLE) AS total")
        .replace("COALESCE(c.discount_lc, a.discount_lc) AS discount_lc", "CAST(COALESCE(c.discount_lc, a.discount_lc) AS DOUBLE) AS discount_lc"))
    q["settlement_products"] = with_ctes(["pairs", "rep", "offers", "vendors", "supplier_info", "chain_products", "products"], """
SELECT * REPLACE (CAST(chain_product_created_at AS VARCHAR) AS chain_product_created_at) FROM products""")
    q["curated_order_items"] = with_ctes(["entities"], """
, li AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS sku, CASE WHEN l.l_returnflag = 'R' THEN 0 ELSE CAST(l.l_quantity AS BIGINT) END AS sold,
    CASE WHEN l.l_discount > 0 THEN 'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) END AS c1,
    CASE WHEN l.l_partkey % 2 = 0 THEN 'C2-' || p.p_type || '-' || CAST(p.p_size % 3 AS VARCHAR) END AS c2,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS listed,
    CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(CASE WHEN l.l_discount > 0 THEN l.l_discount ELSE 0 END AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS disc,
    p.p_size, l.l_quantity, l.l_discount
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
m AS (
  SELECT *, listed - disc AS paid, CASE WHEN p_size % 2 = 0 THEN CAST(ROUND(disc * 0.5, 2) AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS funded FROM li)
SELECT o.o_orderkey AS order_id, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date, e.global_entity_id, e.country_code,
  COALESCE(bool_or(m.c1 IS NOT NULL OR m.c2 IS NOT NULL), FALSE) AS order_has_campaigns, COUNT(m.l_orderkey) AS n_items,
  COALESCE(string_agg(m.l_linenumber || ':' || m.sku || ':' || m.sold || ':' || concat_ws('+', m.c1, m.c2), ','
    ORDER BY m.l_linenumber, m.sku, m.l_quantity, m.sold), '') AS item_texts,
  CAST(COALESCE(SUM(CASE WHEN m.c1 IS NOT NULL THEN m.disc END), 0) AS DOUBLE) AS campaign_discount_lc,
  CAST(COALESCE(SUM(m.paid), 0) AS DOUBLE) AS items_paid_lc, CAST(COALESCE(SUM(m.paid * r.rate), 0) AS DOUBLE) AS items_paid_euro,
  CAST(COALESCE(SUM(m.listed), 0) AS DOUBLE) AS order_listed_lc, CAST(COALESCE(SUM(m.disc), 0) AS DOUBLE) AS order_discount_lc,
  CAST(COALESCE(SUM(m.funded), 0) AS DOUBLE) AS order_funded_lc, CAST(COALESCE(SUM(m.paid * r.rate), 0) AS DOUBLE) AS order_paid_euro,
  CAST(COALESCE(SUM(m.funded * r.rate), 0) AS DOUBLE) AS order_funded_euro
FROM orders o JOIN entities e ON o.o_custkey = e.c_custkey
JOIN (VALUES ('AFRICA', 0.25), ('AMERICA', 0.75), ('ASIA', 0.50), ('EUROPE', 1.00), ('MIDDLE EAST', 1.25)) r(entity, rate) ON r.entity = e.global_entity_id
LEFT JOIN m ON o.o_orderkey = m.l_orderkey
GROUP BY ALL""")
    scoped = CTE["t4_lines"].replace("FROM order_lines ol", "FROM day_lines ol")
    dedup = CTE["t4_dedup"].replace("PARTITION BY order_id, sku", "PARTITION BY order_id, sku, day_kind")
    chain = [n for n in V2_CHAIN]
    chain.insert(chain.index("t4_lines"), "day_lines")
    q["local_day_funding"] = with_ctes(chain, """
SELECT global_entity_id, order_id, sku,
  CAST(MAX(CASE WHEN day_kind = 'utc' THEN order_date END) AS VARCHAR) AS order_date_utc,
  CAST(MAX(CASE WHEN day_kind = 'local' THEN order_date END) AS VARCHAR) AS order_date_lt,
  MAX(CASE WHEN day_kind = 'utc' THEN funding_campaign_id END) AS campaign_by_utc_day,
  MAX(CASE WHEN day_kind = 'local' THEN funding_campaign_id END) AS campaign_by_local_day,
  CAST(MAX(CASE WHEN day_kind = 'utc' THEN funding_amount_lc END) AS DOUBLE) AS amount_by_utc_day,
  CAST(MAX(CASE WHEN day_kind = 'local' THEN funding_amount_lc END) AS DOUBLE) AS amount_by_local_day
FROM t4 GROUP BY global_entity_id, order_id, sku""", {"t4_lines": scoped, "t4_dedup": dedup})


_EXTRA.append(_merges)


# ----------------------------------------------------------------- clean tables by entity
def _clean_by_entity(q: dict[str, str]) -> None:
    q["product_texts"] = """
SELECT p_partkey, split_part(p_brand, '#', 2) AS brand_no, string_split(p_name, ' ')[2] AS second_word, string_split(p_name, ' ')[10] AS tenth_word,
  CASE WHEN p_partkey % 5 <> 0 THEN replace(p_name, ' ', '|') END AS joined,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(len(string_split(p_name, ' ')) AS BIGINT) END AS n_words,
  CASE p_partkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS is_flagged,
  CASE WHEN p_partkey % 3 <> 0 THEN LEAST(CAST(p_size AS BIGINT), p_partkey) END AS least_of_both,
  epoch_us(CAST(d AS TIMESTAMP)) AS day_start, epoch_us(zoned) AS zoned_at, zoned >= TIMESTAMP '1998-03-29 01:00:00' AS in_summer_time
FROM (SELECT *, CAST(d AS TIMESTAMP) + INTERVAL 1410 MINUTE + CASE WHEN p_partkey % 2 = 0 THEN INTERVAL '-2' HOUR ELSE INTERVAL 5 HOUR END AS zoned
      FROM (SELECT *, DATE '1998-03-20' + CAST(p_partkey % 30 AS INTEGER) AS d FROM part) x) y"""
    base = ["campaign_rows", "campaigns", "entity_campaigns"]
    q["clean_campaign_versions"] = with_ctes([*base, "raw_c"], """
SELECT country_code, global_entity_id, campaign_id, campaign_name, campaign_type, target_audience, target_audience_id, applies_to, discount_type,
  discount_value, epoch_us(created_at_utc) AS created_at_utc, epoch_us(updated_at_utc) AS updated_at_utc, epoch_us(start_at_utc) AS start_at_utc,
  epoch_us(end_at_utc) AS end_at_utc, is_active, root_id, state, is_valid, """ + SUBTYPE_CASE + """ AS campaign_subtype
FROM (
  SELECT country_code, global_entity_id, campaign_id, campaign_name,
    CASE WHEN type IN ('Generic', 'GENERIC', 'OldFashioned Campaign Type') THEN 'Generic' ELSE type END AS campaign_type,
    CASE WHEN target_audience IS NOT NULL AND target_audience NOT IN ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
         THEN 'SEGMENT_USER' ELSE target_audience END AS target_audience,
    CASE WHEN target_audience IS NOT NULL AND target_audience NOT IN ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
         THEN target_audience END AS target_audience_id,
    applies_to, json_extract_string(discount, '$.type') AS discount_type, TRY_CAST(json_extract_string(discount, '$.value') AS DOUBLE) AS discount_value,
    creation_date AS created_at_utc, updated_date AS updated_at_utc, start_time AS start_at_utc, end_time AS end_at_utc, active AS is_active, root_id, state,
    NOT (updated_date < start_time AND active IS FALSE) AS is_valid
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY country_code, campaign_id ORDER BY creation_date DESC, p_partkey, global_entity_id) AS rn
    FROM (SELECT r.*, e.country_code, e.global_entity_id, CAST(e.start_date - CAST(r.p_partkey % 30 AS INTEGER) AS TIMESTAMP) AS creation_date
          FROM raw_c r JOIN entity_campaigns e ON r.campaign_id = e.campaign_id) x) y WHERE rn = 1) z""")
    q["merged_benefit_versions"] = with_ctes([*base, "benefits"], """
, b AS (
  SELECT e.country_code, e.global_entity_id, b.campaign_id, b.sku, b.supplier_funding_type, b.supplier_funding_value, b.is_deleted, e.start_date
  FROM benefits b JOIN entity_campaigns e ON b.campaign_id = e.campaign_id),
u AS (
  SELECT country_code, global_entity_id, campaign_id, sku, supplier_funding_type, supplier_funding_value, CAST(start_date - 3 AS TIMESTAMP) AS created_at,
    CAST(start_date AS TIMESTAMP) AS updated_at, is_deleted, 'Old benefits' AS src, 2 AS src_priority FROM b
  UNION ALL
  SELECT country_code, global_entity_id, campaign_id, sku, supplier_funding_type, CAST(supplier_funding_value + (sku % 3 + 1) * 0.50 AS DECIMAL(18,2)),
    CAST(start_date AS TIMESTAMP), CAST(start_date + CAST(sku % 3 AS INTEGER) AS TIMESTAMP), sku % 3 = 2 AND sku % 5 = 0, 'New benefits', 1
  FROM b WHERE supplier_funding_type = 'ABSOLUTE' AND supplier_funding_value > 0)
SELECT country_code, global_entity_id, campaign_id, sku, supplier_funding_type, CAST(supplier_funding_value AS DOUBLE) AS supplier_funding_value,
  epoch_us(created_at) AS created_at_utc, epoch_us(updated_at) AS updated_at_utc, is_deleted, src, CAST(src_priority AS BIGINT) AS src_priority
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_code, global_entity_id, campaign_id, sku ORDER BY src_priority) AS rn FROM u) x WHERE rn = 1""")
    q["clean_campaign_vendors"] = with_ctes([*base, "vendors", "campaign_vendors"], """
, r AS (
  SELECT e.country_code, e.global_entity_id, e.campaign_id, cv.vendor_id, v.version, e.start_date, CAST(split_part(cv.vendor_id, '-', 2) AS INTEGER) AS k
  FROM campaign_vendors cv JOIN entity_campaigns e ON cv.global_entity_id = e.global_entity_id AND cv.campaign_id = e.campaign_id,
       (VALUES (0), (1), (2)) v(version)),
t AS (
  SELECT *, CAST(start_date + version AS TIMESTAMP) AS created,
    CAST(CASE WHEN (k + version) % 3 <> 0 THEN start_date + (10 - 3 * version) WHEN k % 6 = 1 THEN start_date + 2 END AS TIMESTAMP) AS updated
  FROM r WHERE k % 4 <> 3 OR version = 0)
SELECT country_code, global_entity_id, campaign_id, vendor_id AS catalog_global_vendor_id, epoch_us(created) AS created_at_utc,
  epoch_us(COALESCE(updated, created)) AS updated_at_utc
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_code, global_entity_id, campaign_id, vendor_id ORDER BY updated DESC NULLS LAST, created) AS rn
      FROM t) x WHERE rn = 1""")
    q["clean_vendor_versions"] = """
SELECT lower(substr(r_name, 1, 2)) AS country_code, r_name AS global_entity_id, s_suppkey AS catalog_global_vendor_id,
  CASE WHEN r_name LIKE 'AS_A' OR r_name LIKE 'EU%' OR r_name LIKE 'M_D%' THEN NULL ELSE code END AS catalog_remote_vendor_id,
  CASE WHEN r_name LIKE 'AS_A' OR r_name LIKE 'EU%' OR r_name LIKE 'M_D%' THEN code END AS catalog_additional_remote_vendor_id, s_name AS name,
  epoch_us(CAST(d0 - 100 AS TIMESTAMP)) AS created_at_utc, epoch_us(CAST(d0 + v AS TIMESTAMP)) AS updated_at_utc,
  epoch_us(CASE WHEN v = 1 AND s_suppkey % 9 = 0 THEN CAST(d0 + 1 AS TIMESTAMP) END) AS deleted_at_utc,
  epoch_us(CAST(d0 + 2 * v AS TIMESTAMP)) AS synchronized_at_utc
FROM (SELECT *, CAST(1 - s_suppkey % 2 AS INTEGER) AS v, 'C' || s_suppkey || '-' || (1 - s_suppkey % 2) AS code,
        DATE '2020-01-01' + CAST(s_suppkey % 50 AS INTEGER) AS d0 FROM supplier) s
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA'"""
    q["merged_trigger_versions"] = with_ctes([*base, "benefits", "raw_t"], """
, old AS (
  SELECT e.country_code, e.global_entity_id, t.campaign_id, COALESCE(t.sku, t.product_id) AS sku, t.modified_at AS created_at, t.modified_at AS updated_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_id, product_id ORDER BY modified_at DESC NULLS LAST, vendor_id) AS rn
        FROM (SELECT campaign_id, product_id, sku, vendor_id, modified_at FROM raw_t
              UNION ALL
              SELECT campaign_id, product_id, sku, (vendor_id + 1) % 10, modified_at + INTERVAL 1 DAY FROM raw_t WHERE p_size > 25) r) t
  JOIN entity_campaigns e ON t.campaign_id = e.campaign_id WHERE t.rn = 1),
u AS (
  SELECT *, FALSE AS is_deleted, 'Old triggers' AS src, 2 AS src_priority FROM old
  UNION ALL
  SELECT e.country_code, e.global_entity_id, b.campaign_id, b.sku, CAST(e.start_date AS TIMESTAMP),
    CAST(e.start_date + CASE WHEN b.sku % 8 = 0 THEN 1 ELSE 0 END AS TIMESTAMP), b.sku % 8 = 0, 'New triggers', 1
  FROM benefits b JOIN entity_campaigns e ON b.campaign_id = e.campaign_id WHERE b.sku % 4 = 0)
SELECT country_code, global_entity_id, campaign_id, sku, epoch_us(created_at) AS created_at_utc, epoch_us(updated_at) AS updated_at_utc, is_deleted, src,
  CAST(src_priority AS BIGINT) AS src_priority
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY country_code, global_entity_id, campaign_id, sku ORDER BY src_priority) AS rn FROM u) x WHERE rn = 1""")

    def part(name):
        """A registered query as a table; its CTEs stay its own."""
        return f"SELECT * FROM ({q[name]}) {name}"

    q["curated_campaigns"] = f"""
SELECT c.country_code, c.global_entity_id, c.campaign_id, c.campaign_type, c.campaign_subtype, c.state, c.is_valid, c.created_at_utc,
  epoch_us(TIMESTAMP '2025-01-01 00:00:00') AS ingested_at, COALESCE(b.list, '') AS benefit_list, COALESCE(b.live, 0.0)::DOUBLE AS live_funding_value,
  b.last AS benefits_updated_at, COALESCE(t.list, '') AS trigger_list, COALESCE(v.list, '') AS vendor_list, v.last AS vendors_updated_at
FROM ({part("clean_campaign_versions")}) c
LEFT JOIN (SELECT country_code, campaign_id, string_agg(sku || ':' || left(src, 3) || ':' || is_deleted, ',' ORDER BY sku, global_entity_id) AS list,
             CAST(SUM(CAST(CASE WHEN is_deleted THEN 0 ELSE COALESCE(supplier_funding_value, 0) END AS DECIMAL(18,2))) AS DOUBLE) AS live, MAX(updated_at_utc) AS last
           FROM ({part("merged_benefit_versions")}) x GROUP BY 1, 2) b ON c.country_code = b.country_code AND c.campaign_id = b.campaign_id
LEFT JOIN (SELECT country_code, campaign_id, string_agg(sku || ':' || left(src, 3) || ':' || is_deleted, ',' ORDER BY sku) AS list
           FROM ({part("merged_trigger_versions")}) x GROUP BY 1, 2) t ON c.country_code = t.country_code AND c.campaign_id = t.campaign_id
LEFT JOIN (SELECT country_code, campaign_id, string_agg(catalog_global_vendor_id, ',' ORDER BY catalog_global_vendor_id) AS list, MAX(updated_at_utc) AS last
           FROM ({part("clean_campaign_vendors")}) x GROUP BY 1, 2) v ON c.country_code = v.country_code AND c.campaign_id = v.campaign_id"""


_EXTRA.append(_clean_by_entity)


# ----------------------------------------------------------------- curated catalogue
def _catalogue(q: dict[str, str]) -> None:
    q["line_campaign_info"] = with_ctes(["lr", "fan"], """
, ext AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS sku,
    'C1-' || substr(p.p_brand, 7, 8) || '-' || CAST(p.p_size % 4 AS VARCHAR) AS campaign_id,
    CAST(ROUND(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(4,2)), 2) * 0.8, 2) AS DECIMAL(18,2)) AS external_funded_lc
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_returnflag = 'R' AND l.l_discount > 0),
x AS (
  SELECT f.order_id, f.sku, f.campaign_id, CASE WHEN e.external_funded_lc IS NOT NULL THEN 'external' WHEN f.promo_funded_lc IS NOT NULL THEN 'promotool' END AS src,
    COALESCE(e.external_funded_lc, f.promo_funded_lc) AS amount
  FROM fan f LEFT JOIN ext e ON f.order_id = e.order_id AND f.sku = e.sku AND f.campaign_id = e.campaign_id)
SELECT order_id, sku, COUNT(campaign_id) AS n_campaigns,
  COALESCE(string_agg(campaign_id || ':' || COALESCE(src, '-') || ':' || COALESCE(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), '-'), ','
    ORDER BY campaign_id, src NULLS FIRST, amount NULLS FIRST) FILTER (WHERE campaign_id IS NOT NULL), '') AS campaigns,
  CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS funded_lc
FROM x GROUP BY order_id, sku""")
    q["curated_catalogue"] = with_ctes(["pairs", "vendors", "dmart", "vat_hist", "buffer_hist"], """
, listed AS (SELECT DISTINCT pr.sku, s.s_nationkey, s.s_suppkey % 10 AS k FROM pairs pr JOIN supplier s ON pr.supplier_id = s.s_suppkey),
vp AS (
  SELECT v.global_entity_id, lower(substr(v.global_entity_id, 1, 2)) AS country_code, l.sku,
    p.p_name || CASE WHEN ch.chain = 1 THEN ' new' ELSE '' END AS product_name, p.p_brand AS brand_name,
    CASE WHEN l.sku % 10 = 0 AND ch.chain = 0 THEN NULL ELSE DATE '2000-01-01' + CAST(l.sku % 100 + ch.chain * 30 AS INTEGER) END AS created,
    v.vendor_id, COALESCE(v.warehouse_id, '') AS warehouse_id, CASE WHEN v.k % 3 = 0 THEN 'SHOP' ELSE 'DMART' END AS type,
    CASE WHEN (l.sku + v.k) % 4 <> 0 THEN l.sku % 5 END AS own_buffer, CASE WHEN v.k % 4 = 0 THEN TRUE WHEN v.k % 4 <> 1 THEN FALSE END AS lbi,
    (l.sku + v.k) % 6 = 0 AS evd
  FROM listed l JOIN vendors v ON v.n_nationkey = l.s_nationkey AND v.k = l.k JOIN part p ON p.p_partkey = l.sku
  JOIN (VALUES (0), (1)) ch(chain) ON ch.chain = 0 OR l.sku % 4 = 0),
buf AS (
  SELECT r.r_name AS entity, b.sku, b.sales_buffer + 10 AS sales_buffer
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY valid_to DESC, valid_from DESC) AS rn FROM buffer_hist) b
  JOIN region r ON r.r_regionkey IN (b.sku % 5, (b.sku + 1) % 5) WHERE b.rn = 1),
vat AS (
  SELECT sku, vat_pct + step AS vat_rate FROM vat_hist, (VALUES (0), (2)) e(step) WHERE valid_to = DATE '9999-12-31' AND sku % 7 <> 0),
loc AS (SELECT DISTINCT warehouse_id, sku FROM dmart WHERE sku % 2 = 0),
wide AS (
  SELECT vp.*, vat.vat_rate, loc.sku IS NOT NULL AS placed,
    CASE WHEN vp.type = 'SHOP' THEN COALESCE(vp.own_buffer, buf.sales_buffer, 0) ELSE COALESCE(buf.sales_buffer, 0) END AS sales_buffer
  FROM vp LEFT JOIN buf ON vp.global_entity_id = buf.entity AND vp.sku = buf.sku
  LEFT JOIN vat ON vp.sku = vat.sku
  LEFT JOIN loc ON vp.warehouse_id = loc.warehouse_id AND vp.sku = loc.sku AND NOT vp.lbi),
agg AS (
  SELECT global_entity_id, country_code, sku, product_name, brand_name, created, bool_or(evd) AS evd, COUNT(*) AS n_vendor_products,
    COUNT(DISTINCT vendor_id) AS n_vendors, CAST(SUM(COALESCE(vat_rate, 0)) AS BIGINT) AS vat_sum, CAST(SUM(sales_buffer) AS BIGINT) AS buffer_sum,
    COUNT(*) FILTER (WHERE placed) AS n_placed, COUNT(*) FILTER (WHERE warehouse_id = '') AS n_without_warehouse
  FROM wide GROUP BY 1, 2, 3, 4, 5, 6)
SELECT a.global_entity_id, a.country_code, a.sku, a.product_name, a.brand_name, CAST(a.created AS VARCHAR) AS chain_product_created_at, s.chain_id,
  s.chain_id IS NOT NULL AS is_chain_from_dmart,
  CASE WHEN a.sku % 3 <> 0 THEN a.brand_name = 'Brand#3' END OR (a.brand_name IN ('Brand#1', 'Brand#2') AND a.evd) AS is_evd_product,
  a.n_vendor_products, a.n_vendors, a.vat_sum, a.buffer_sum, a.n_placed, a.n_without_warehouse
FROM agg a LEFT JOIN (VALUES ('ASIA', 'c1'), ('ASIA', 'c2'), ('EUROPE', 'c1')) s(entity, chain_id) ON a.global_entity_id = s.entity""")


_EXTRA.append(_catalogue)
