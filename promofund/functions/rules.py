"""Business rules held as data.

Each rule table is a plain Python list; a small builder folds it into one
chained ``CASE WHEN`` column, so the rules run inside whole-stage codegen.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# ------------------------------------------------------------------ fixed values
# Fixed values that must equal the reference's for the same results.
# Campaign-type aliases normalised to 'Generic' (C14):
GENERIC_TYPE_ALIASES = ("Generic", "GENERIC", "OldFashioned Campaign Type")
# Audience values that are not a segment id (C14):
AUDIENCE_KEYWORDS = ("RETURNING", "ALL", "SUBSCRIBED_USER", "NEW_USER")
# applies_to values that count as "products" in the subtype table (C13):
PRODUCT_TARGETS = ("PRODUCTS", "CHEAPEST_PRODUCTS")
# Campaign subtype rule table (C13), first match wins, no match -> NULL.
# Columns: campaign_type, applies_to ('P' = PRODUCT_TARGETS), discount_type
# (None = any), discount_value test (None = any, '=100', '<100'), subtype.
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
# Contract statuses (C17) and T4 config vocabularies.
STATUS_MISSING, STATUS_ZERO, STATUS_CONFIGURED = "missing", "explicit_zero", "configured"
# ------------------------------------------------------------------ end fixed values


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalise_campaign_type(type_col) -> Column:
    """C14: type aliases -> 'Generic', everything else unchanged."""
    t = _col(type_col)
    return F.when(t.isin(*GENERIC_TYPE_ALIASES), F.lit("Generic")).otherwise(t)


def audience_split(aud_col) -> tuple[Column, Column]:
    """(target_audience, target_audience_id).

    A value outside the keyword list is a segment id: it becomes
    ('SEGMENT_USER', value). NULL stays (NULL, NULL).
    """
    a = _col(aud_col)
    is_segment = a.isNotNull() & ~a.isin(*AUDIENCE_KEYWORDS)
    return (F.when(is_segment, F.lit("SEGMENT_USER")).otherwise(a),
            F.when(is_segment, a))


def campaign_subtype(type_col, applies_col, dtype_col, dvalue_col) -> Column:
    """Fold ``SUBTYPE_RULES`` into one CASE (first match wins, else NULL)."""
    t, a, dt, dv = _col(type_col), _col(applies_col), _col(dtype_col), _col(dvalue_col)
    out = None
    for ctype, applies, dtype, vtest, subtype in SUBTYPE_RULES:
        cond = t == ctype
        if applies == "P":
            cond = cond & a.isin(*PRODUCT_TARGETS)
        elif applies is not None:
            cond = cond & (a == applies)
        if dtype is not None:
            cond = cond & (dt == dtype)
        if vtest == "=100":
            cond = cond & (dv == 100.0)
        elif vtest == "<100":
            cond = cond & (dv < 100.0)
        out = F.when(cond, F.lit(subtype)) if out is None else out.when(cond, F.lit(subtype))
    return out


def validity_flag(updated_col, start_col, active_col) -> Column:
    """FALSE when updated before start AND the campaign is not active
    (``active IS FALSE``: NULL active keeps the campaign valid)."""
    cond = (_col(updated_col) < _col(start_col)) & _col(active_col).eqNullSafe(False)
    return F.when(cond, F.lit(False)).otherwise(F.lit(True))


def contract_status(ftype_col, fvalue_col) -> Column:
    """C17: missing / explicit_zero / configured."""
    ft, fv = _col(ftype_col), _col(fvalue_col)
    return (F.when(ft.isNull() & fv.isNull(), F.lit(STATUS_MISSING))
            .when(fv == 0, F.lit(STATUS_ZERO))
            .when(ft.isNotNull() & (fv > 0), F.lit(STATUS_CONFIGURED))
            .otherwise(F.lit(STATUS_MISSING)))


def funding_unit_value(ftype_col, fvalue_col) -> Column:
    """ABSOLUTE > 0 -> value; value 0 -> 0; else NULL (PERCENTAGE
    contracts therefore pay nothing in T4)."""
    ft, fv = _col(ftype_col), _col(fvalue_col)
    return (F.when((ft == "ABSOLUTE") & (fv > 0), fv.cast(MONEY))
            .when(fv == 0, F.lit(Decimal("0.00")).cast(MONEY)))


def per_benefit_units(qty_col, threshold_col, limit_col) -> Column:
    """N2-safe ``LEAST(FLOOR(qty/threshold), COALESCE(NULLIF(limit,0), FLOOR(qty/threshold)))``.

    The reference's ``LEAST`` returns NULL when an argument is NULL; Spark's
    skips NULLs, so a NULL/0 threshold is mapped to NULL explicitly.
    """
    q, thr, lim = _col(qty_col), _col(threshold_col), _col(limit_col)
    times = F.floor(q / F.nullif(thr, F.lit(0)))
    capped = F.least(times, F.coalesce(F.nullif(lim, F.lit(0)), times))
    return F.when(thr.isNull() | (thr == 0), F.lit(None).cast("bigint")).otherwise(capped)


def funding_total(*, require_discount, has_discount, status, fallback, unit_value,
                  convention, quantity, full_discount_amount, threshold, limit) -> Column:
    """C20: the T4 funding formula, 7 ordered branches (see FIXTURES §2).

    ``full_discount_amount`` is the line's rounded discount total, charged when
    the contract is missing and the entity's fallback is 'full_discount'.
    Returns decimal(18,2); NULL only for per_benefit with a NULL/0 threshold.
    """
    zero = F.lit(Decimal("0.00")).cast(MONEY)
    rq, hd, st, fb = _col(require_discount), _col(has_discount), _col(status), _col(fallback)
    uv, cv, qty = _col(unit_value), _col(convention), _col(quantity)
    return (F.when((rq == True) & (hd == False), zero)  # noqa: E712 (three-valued)
            .when((st == STATUS_MISSING) & (fb == "skip"), zero)
            .when((st == STATUS_MISSING) & (fb == "full_discount"),
                  F.round(_col(full_discount_amount), 2).cast(MONEY))
            .when(st == STATUS_ZERO, zero)
            .when(uv.isNull(), zero)
            .when(cv == "normalized", F.round(uv * qty.cast("bigint"), 2).cast(MONEY))
            .when(cv == "per_benefit",
                  F.round(uv * per_benefit_units(qty, threshold, limit), 2).cast(MONEY))
            .otherwise(zero))


def source_switch(source_col, negotiated_col, v1_col) -> tuple[Column, Column]:
    """(funding_amount, delta) by funding source; unknown -> NULL."""
    s, neg = _col(source_col), _col(negotiated_col)
    v1 = F.coalesce(_col(v1_col), F.lit(Decimal("0.00")).cast(MONEY))
    amount = F.when(s == "negotiated", neg).when(s == "promotool", v1)
    delta = (F.when(s == "negotiated", (neg - v1).cast(MONEY))
             .when(s == "promotool", F.lit(Decimal("0.00")).cast(MONEY)))
    return amount.cast(MONEY), delta.cast(MONEY)


def type_dependent_amount(type_col, discount_col, funded_col, discount_type: str = "GroupValue") -> Column:
    """Campaigns of ``discount_type`` charge the discount, others the
    supplier-funded amount; NULL -> 0."""
    return F.coalesce(F.when(_col(type_col) == discount_type, _col(discount_col)).otherwise(_col(funded_col)),
                      F.lit(0).cast(MONEY)).cast(MONEY)
