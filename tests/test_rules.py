"""Rule tables (C13–C22) against FIXTURES.md §2 golden cases."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from promofund.functions import rules as R
from promofund.functions import scalars as S

DEC = Decimal


def test_contract_status_and_unit_value(spark):
    rows = [
        (None, None, "missing", None),
        ("ABSOLUTE", DEC("0"), "explicit_zero", DEC("0.00")),
        (None, DEC("0"), "explicit_zero", DEC("0.00")),
        ("ABSOLUTE", DEC("2.5"), "configured", DEC("2.50")),
        ("PERCENTAGE", DEC("10"), "configured", None),
        (None, DEC("3"), "missing", None),
        ("ABSOLUTE", None, "missing", None),
        ("ABSOLUTE", DEC("-1"), "missing", None),
    ]
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "t string, v decimal(18,2)")
    got = df.select(R.contract_status("t", "v").alias("s"), R.funding_unit_value("t", "v").alias("u")).collect()
    for (t, v, status, unit), g in zip(rows, got):
        assert g.s == status, (t, v)
        assert g.u == unit, (t, v)


FORMULA = [
    # require, has_disc, status, fallback, unit, convention, qty, full_disc, thr, lim, expected
    (False, True, "configured", "skip", DEC("0.50"), "normalized", 10, DEC("9.99"), None, None, DEC("5.00")),
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 8, DEC("0"), 3, 1, DEC("1.25")),
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 8, DEC("0"), 3, 0, DEC("2.50")),
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 8, DEC("0"), 3, None, DEC("2.50")),
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 2, DEC("0"), 3, 1, DEC("0.00")),
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 8, DEC("0"), 0, 1, None),      # N2
    (False, True, "configured", "skip", DEC("1.25"), "per_benefit", 8, DEC("0"), None, 1, None),   # N2
    (True, False, "configured", "skip", DEC("1.25"), "normalized", 8, DEC("0"), None, None, DEC("0.00")),
    (False, True, "missing", "skip", None, "normalized", 8, DEC("7.77"), None, None, DEC("0.00")),
    (False, True, "missing", "full_discount", None, "normalized", 8, DEC("7.77"), None, None, DEC("7.77")),
    (False, True, "explicit_zero", "skip", DEC("0.00"), "normalized", 8, DEC("0"), None, None, DEC("0.00")),
    (False, True, "configured", "skip", DEC("1.25"), "legacy", 8, DEC("0"), None, None, DEC("0.00")),
    (False, True, None, "skip", None, "normalized", 8, DEC("0"), None, None, DEC("0.00")),           # no rule matched
]


def test_funding_formula(spark):
    schema = ("rq boolean, hd boolean, st string, fb string, uv decimal(18,2), cv string, q bigint, "
              "fd decimal(18,2), thr bigint, lim bigint")
    df = spark.createDataFrame([r[:-1] for r in FORMULA], schema)
    col = R.funding_total(require_discount="rq", has_discount="hd", status="st", fallback="fb", unit_value="uv",
                          convention="cv", quantity="q", full_discount_amount="fd", threshold="thr", limit="lim")
    got = [r.f for r in df.select(col.alias("f")).collect()]
    assert got == [r[-1] for r in FORMULA]


def test_source_switch(spark):
    df = spark.createDataFrame([("negotiated", DEC("5.00"), DEC("2.00")), ("promotool", DEC("5.00"), None),
                                ("other", DEC("5.00"), DEC("2.00"))], "s string, n decimal(18,2), v decimal(18,2)")
    amount, delta = R.source_switch("s", "n", "v")
    got = [(r.a, r.d) for r in df.select(amount.alias("a"), delta.alias("d")).collect()]
    assert got == [(DEC("5.00"), DEC("3.00")), (DEC("0.00"), DEC("0.00")), (None, None)]


def test_audience_split(spark):
    df = spark.createDataFrame([("ALL",), ("seg-9",), (None,), ("NEW_USER",)], "a string")
    aud, aud_id = R.audience_split("a")
    got = [(r.x, r.y) for r in df.select(aud.alias("x"), aud_id.alias("y")).collect()]
    assert got == [("ALL", None), ("SEGMENT_USER", "seg-9"), (None, None), ("NEW_USER", None)]


@pytest.mark.parametrize("ctype,applies,dtype,value,expected", [
    ("Strikethrough", "PRODUCTS", "ABSOLUTE", 5.0, "Strikethrough $"),
    ("Strikethrough", "CHEAPEST_PRODUCTS", "PERCENTAGE", 5.0, "Strikethrough %"),
    ("SameItemBundle", "PRODUCTS", "PERCENTAGE", 100.0, "Multibuy: Same Item - Free Item"),
    ("SameItemBundle", "PRODUCTS", "PERCENTAGE", 50.0, "Multibuy: Same Item %"),
    ("MixAndMatch", "DELIVERY_FEE", None, None, "Multibuy: Mix & Match - Delivery Fee Discount"),
    ("BasketValue", "BASKET", "ABSOLUTE", 5.0, "Basket Discount $"),
    ("BasketValue", "PRODUCTS", "PERCENTAGE", 100.0, "Basket Discount - Free Item"),
    ("BasketValue", "PRODUCTS", "PERCENTAGE", 50.0, None),
    ("Generic", None, None, None, "Generic"),
    ("Unknown", "PRODUCTS", "ABSOLUTE", 1.0, None),
])
def test_campaign_subtype(spark, ctype, applies, dtype, value, expected):
    df = spark.createDataFrame([(ctype, applies, dtype, value)], "t string, a string, d string, v double")
    got = df.select(R.campaign_subtype("t", "a", "d", "v").alias("s")).first().s
    assert got == expected


def test_type_normalisation_and_validity(spark):
    df = spark.createDataFrame([("GENERIC", 1, 2, False), ("OldFashioned Campaign Type", 3, 2, None),
                                ("Strikethrough", 1, 2, True)], "t string, u int, s int, a boolean")
    got = [(r.t, r.v) for r in df.select(R.normalise_campaign_type("t").alias("t"),
                                         R.validity_flag("u", "s", "a").alias("v")).collect()]
    assert got == [("Generic", False), ("Generic", True), ("Strikethrough", True)]


def test_scalars(spark):
    df = spark.createDataFrame([('{"k": 5, "o": {"x": 1}}', "true", "a,b")], "j string, b string, s string")
    r = df.select(S.json_scalar("j", "$.k").alias("k"), S.json_scalar("j", "$.o").alias("o"),
                  S.safe_double(F.lit("x1")).alias("bad"), S.text_to_bool("b").alias("tb"),
                  S.text_to_bool(F.lit("1")).alias("one"), S.split_part_safe("s", ",", 5).alias("p"),
                  S.strict_least(F.lit(None).cast("int"), F.lit(3)).alias("lst"),
                  S.safe_divide(F.lit(1.0), F.lit(0.0)).alias("sd")).first()
    assert (r.k, r.o, r.bad, r.tb, r.one, r.p, r.lst, r.sd) == ("5", None, None, True, None, None, None, None)


def _formula_brute(rq, hd, st, fb, uv, cv, q, fd, thr, lim):
    """Plain-Python statement of the funding formula (reference semantics)."""
    from decimal import ROUND_HALF_UP
    z = DEC("0.00")
    if rq is True and hd is False:
        return z
    if st == "missing" and fb == "skip":
        return z
    if st == "missing" and fb == "full_discount":
        return fd.quantize(DEC("0.01"), ROUND_HALF_UP)
    if st == "explicit_zero":
        return z
    if uv is None:
        return z
    if cv == "normalized":
        return (uv * q).quantize(DEC("0.01"), ROUND_HALF_UP)
    if cv == "per_benefit":
        if thr is None or thr == 0:
            return None                       # LEAST with a NULL argument is NULL
        times = q // thr
        cap = lim if lim not in (None, 0) else times
        return (uv * min(times, cap)).quantize(DEC("0.01"), ROUND_HALF_UP)
    return z


def test_funding_formula_random_vs_brute_force(spark):
    import random
    rnd = random.Random(11)
    pick = rnd.choice
    rows = []
    for _ in range(400):
        rows.append((pick([True, False, None]), pick([True, False, None]),
                     pick(["missing", "explicit_zero", "configured", None]), pick(["skip", "full_discount", "x"]),
                     pick([None, DEC("0.00"), DEC(rnd.randint(1, 999)) / 100]),
                     pick(["normalized", "per_benefit", "legacy", None]), rnd.randint(0, 60),
                     DEC(rnd.randint(0, 99999)) / 100, pick([None, 0, 1, 2, 3, 5]), pick([None, 0, 1, 2, 4])))
    schema = ("rq boolean, hd boolean, st string, fb string, uv decimal(18,2), cv string, q bigint, "
              "fd decimal(18,2), thr bigint, lim bigint")
    df = spark.createDataFrame(rows, schema)
    col = R.funding_total(require_discount="rq", has_discount="hd", status="st", fallback="fb", unit_value="uv",
                          convention="cv", quantity="q", full_discount_amount="fd", threshold="thr", limit="lim")
    got = [r.f for r in df.select(col.alias("f")).collect()]
    assert got == [_formula_brute(*r) for r in rows]


def test_array_helpers_and_config_schema(spark):
    from promofund.sources import domain
    df = spark.createDataFrame([(["a", None, "b"],), (None,)], "a array<string>")
    got = [(r.s, r.n) for r in df.select(S.array_to_string_strict("a", ",").alias("s"),
                                         S.size_or_null("a").alias("n")).collect()]
    assert got == [("a,b", 3), (None, None)]
    cfg = domain.config(spark, active_only=False)
    comments = {f.name: f.metadata.get("comment") for f in cfg.schema.fields}
    assert all(comments.values()) and "join_strategy" in comments      # A4: typed schema with comments
    assert cfg.where("is_active").count() == len(domain.CONFIG_ROWS) - 1
