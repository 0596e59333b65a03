"""Validity-interval joins and histories.

Spark has no range join. An interval join on equi keys + ``point BETWEEN
start AND end`` plans as a sort-merge join on the equi keys with the range as a
residual filter; when one key is hot (one SKU with a third of all order lines)
every line of that key lands in one task. ``interval_join`` therefore adds a
time bucket to the equi keys: the point side gets the bucket of its point, the
interval side is exploded into the buckets its interval touches (bounded by
interval length / bucket size, on the small side). Each point still meets each
covering interval exactly once, so the result equals the plain join.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BUCKET = "__bucket"
# Points from this day on share one bucket, so open-ended versions stay few.
SWEEP_LAST = _dt.date(2040, 1, 1)


def _bucket_of(col: Column, grain: str) -> Column:
    return F.trunc(col, grain)


_STEP_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _bucket_array(start: Column, end: Column, grain: str, cap: Column | None = None) -> Column:
    if grain not in _STEP_MONTHS:
        raise ValueError(f"bucket must be one of {sorted(_STEP_MONTHS)}")
    s, e = F.trunc(start, grain), F.trunc(end, grain)
    if cap is not None:
        s, e = F.least(s, F.trunc(cap, grain)), F.least(e, F.trunc(cap, grain))
    step = F.expr(f"interval {_STEP_MONTHS[grain]} month")
    return F.when(s <= e, F.sequence(s, e, step)).otherwise(F.array().cast("array<date>"))


def sweep_bucket(at: str, grain: str = "year") -> Column:
    """The bucket of ``sweep_join`` that a point falls in."""
    return F.least(F.trunc(F.col(at), grain), F.trunc(F.lit(SWEEP_LAST), grain))


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], point: str,
                  start: str, end: str, how: str = "inner", closed: bool = True,
                  bucket: str | None = "month", extra: Column | None = None,
                  keep_bucket: bool = False, bucket_until=None) -> DataFrame:
    """Join rows of ``left`` whose ``point`` falls in ``right``'s interval.

    on      equi-join key columns, same name on both sides
    closed  True: ``start <= point <= end`` (D5); False: ``start <= point < end`` (D6)
    bucket  'month' / 'quarter' time-bucket added to the keys (None: plain join)
    extra   further join condition over columns ``l.*`` / ``r.*`` (D8)
    how     'inner' or 'left'

    ``point``, ``start`` and ``end`` must be dates (or timestamps when
    ``bucket`` is None). Output: every left column, then the right columns
    that are not join keys. With ``keep_bucket`` the bucket column stays, so
    a following window/aggregate can reuse the join's partitioning.
    ``bucket_until`` (a date) caps the bucket explosion of long or open-ended
    intervals: points after it share the last bucket, which every interval
    reaching past it also covers, so no match is lost.
    """
    if how not in ("inner", "left"):
        raise ValueError("interval_join supports how='inner' or 'left'")
    keys = list(on)
    lft, rgt = left, right
    if bucket:
        pcol, scol, ecol = F.col(point), F.col(start), F.col(end)
        if bucket_until is not None:
            cap = F.lit(bucket_until)
            pcol, scol, ecol = F.least(pcol, cap), F.least(scol, cap), F.least(ecol, cap)
        lft = lft.withColumn(_BUCKET, _bucket_of(pcol, bucket))
        rgt = rgt.withColumn(_BUCKET, F.explode(_bucket_array(scol, ecol, bucket)))
        keys = keys + [_BUCKET]
    l, r = lft.alias("l"), rgt.alias("r")
    cond = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    p, s, e = F.col(f"l.{point}"), F.col(f"r.{start}"), F.col(f"r.{end}")
    cond.append(p >= s)
    cond.append(p <= e if closed else p < e)
    if extra is not None:
        cond.append(extra)
    joined = l.join(r, on=cond, how=how)
    left_cols = [F.col(f"l.{c}") for c in lft.columns if keep_bucket or c != _BUCKET]
    right_cols = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return joined.select(*left_cols, *right_cols)


@dataclass(frozen=True)
class History:
    """Versions of one attribute set: rows hold from ``start`` (included) to
    ``end`` (excluded). Versions of one key must not overlap."""
    versions: DataFrame
    start: str
    end: str
    payload: tuple[str, ...]


def hot_parts(points: DataFrame, keys: Sequence[str], rows_per_part: int) -> DataFrame:
    """(keys, __parts) of the keys that hold more than ``rows_per_part`` rows:
    at most rows / rows_per_part of them. ``points`` should be a written table;
    only its key columns are read, and counted map-side first."""
    counts = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_part)
    return counts.select(*keys, F.ceil(F.col("__n") / rows_per_part).cast("int").alias("__parts"))


def sweep_join(points: DataFrame, keys: Sequence[str], at: str, histories: dict[str, History],
               bucket: str | None = "year", parts: DataFrame | None = None) -> DataFrame:
    """Every history's version that holds at a point, for all points: ``points``
    plus one struct column per history (its payload; NULL where none holds).

    Points and versions of all histories are united and swept once: one shuffle
    on (keys, bucket), one sort by time, and ``last(version, ignoreNulls)`` per
    history gives the version that started last, which counts if it hasn't ended.
    A join per history would sort the points again for each. Versions are
    repeated in the buckets they touch, cut to the bucket's start, so a key
    spreads over its buckets; with ``bucket=None`` each version is shuffled once.
    A (key, bucket) that is still hot is dealt over ``parts`` (from ``hot_parts``
    on keys and ``sweep_bucket``, or on the keys alone); its versions go to all of them.
    """
    dealt = [*keys, _BUCKET] if bucket else list(keys)
    group = [*dealt, "__part"]
    pts = points.withColumn(_BUCKET, sweep_bucket(at, bucket)) if bucket else points
    salt = F.lit(0)
    if parts is not None:
        parts = parts.withColumnsRenamed({k: f"__k_{k}" for k in dealt})
        cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in dealt]
        pts = pts.join(parts, cond, "left").drop(*[f"__k_{k}" for k in dealt])
        salt = F.pmod(F.xxhash64(*points.columns), F.coalesce("__parts", F.lit(1))).cast("int")
    kinds = {n: h.versions.schema for n, h in histories.items()}
    shape = {n: T.StructType([T.StructField("__end", kinds[n][h.end].dataType), *[kinds[n][c] for c in h.payload]]) for n, h in histories.items()}
    nothing = {n: F.lit(None).cast(shape[n]).alias(f"__h_{n}") for n in histories}
    swept = pts.select(*dealt, salt.alias("__part"), F.col(at).alias("__at"), F.lit(1).alias("__kind"),
                       F.struct(*points.columns).alias("__row"), *nothing.values())
    row_type = swept.schema["__row"].dataType
    for name, h in histories.items():
        v, start = h.versions, F.col(h.start)
        if bucket:
            v = v.withColumn(_BUCKET, F.explode(_bucket_array(F.col(h.start), F.col(h.end), bucket, F.lit(SWEEP_LAST))))
            start = F.greatest(F.col(h.start), F.col(_BUCKET).cast(kinds[name][h.start].dataType))
        part = F.lit(0)
        if parts is not None:
            cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in dealt]
            v = v.join(parts, cond, "left")
            part = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
        v = v.withColumn("__start", start).where(F.col("__start") < F.col(h.end))
        struct = F.struct(F.col(h.end).alias("__end"), *h.payload).cast(shape[name])
        swept = swept.unionByName(v.select(
            *dealt, part.alias("__part"), F.col("__start").alias("__at"), F.lit(0).alias("__kind"), F.lit(None).cast(row_type).alias("__row"),
            *[struct.alias(f"__h_{n}") if n == name else nothing[n] for n in histories]))
    w = Window.partitionBy(*group).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = swept.withColumns({f"__h_{n}": F.last(f"__h_{n}", ignorenulls=True).over(w) for n in histories})
    held = [F.when(F.col("__at") < F.col(f"__h_{n}.__end"), F.struct(*[F.col(f"__h_{n}.{c}") for c in h.payload])).alias(n)
            for n, h in histories.items()]
    return swept.where("__kind = 1").select("__row.*", *held)


def fallback_join(left: DataFrame, first: DataFrame, first_on: Sequence[str],
                  second: DataFrame, second_on: Sequence[str], payload: Sequence[str],
                  source_col: str = "match_source", names: tuple[str, str] = ("first", "second")) -> DataFrame:
    """A second-chance left join.

    ``left`` meets ``first`` on ``first_on``; only rows that found no partner
    there meet ``second`` on ``second_on`` (the reference's ``AND c.key IS
    NULL`` in the second ON clause). ``payload`` columns exist in both right
    tables; the result carries the first non-NULL attempt and which one hit.
    Both right tables must be unique on their keys (no fan-out).
    """
    a = first.select(*first_on, *[F.col(c).alias(f"__a_{c}") for c in payload]).withColumn("__a_hit", F.lit(True))
    b = second.select(*[F.col(k).alias(f"__b_{k}") for k in second_on],
                      *[F.col(c).alias(f"__b_{c}") for c in payload]).withColumn("__b_hit", F.lit(True))
    step1 = left.join(a, list(first_on), "left")
    cond = [F.col(k) == F.col(f"__b_{k}") for k in second_on] + [F.col("__a_hit").isNull()]
    step2 = step1.join(b, cond, "left")
    out = step2.select(
        *left.columns,
        *[F.coalesce(F.col(f"__a_{c}"), F.col(f"__b_{c}")).alias(c) for c in payload],
        F.when(F.col("__a_hit"), F.lit(names[0])).when(F.col("__b_hit"), F.lit(names[1])).alias(source_col))
    return out


def validity_from_next(df: DataFrame, keys: Sequence[str], ts: str, valid_to: str = "valid_to",
                       open_end=None, tie_break: Sequence[str] = ()) -> DataFrame:
    """``valid_to`` = the next version's start (``lead`` over ascending
    ``ts``), the open end for the newest version."""
    w = Window.partitionBy(*keys).orderBy(F.col(ts).asc(), *[F.col(c).asc() for c in tie_break])
    nxt = F.lead(F.col(ts)).over(w)
    if open_end is not None:
        nxt = F.coalesce(nxt, F.lit(open_end))
    return df.withColumn(valid_to, nxt)


def next_value_split(df: DataFrame, keys: Sequence[str], ts: str, out: str,
                     tie_break: Sequence[str] = (), grain: str = "hour") -> DataFrame:
    """F6 for keys that may hold a large share of all rows:
    ``LEAD(ts) OVER (PARTITION BY keys ORDER BY ts, tie_break)`` computed
    without putting a whole key in one task.

    Rows are windowed per (keys, time bucket); the last row of a bucket takes
    the first ``ts`` of the key's next non-empty bucket, found on a small
    per-bucket aggregate (one row per key and bucket). Equal to the plain
    window (same ``ts`` values always share a bucket).
    """
    b = "__b"
    d = df.withColumn(b, F.date_trunc(grain, F.col(ts)))
    w = Window.partitionBy(*keys, b).orderBy(F.col(ts).asc(), *[F.col(c).asc() for c in tie_break])
    d = d.withColumn("__lead", F.lead(F.col(ts)).over(w))
    firsts = d.groupBy(*keys, b).agg(F.min(ts).alias("__first"))
    wb = Window.partitionBy(*keys).orderBy(F.col(b).asc())
    nxt = firsts.select(*keys, b, F.lead("__first").over(wb).alias("__next_first"))
    return (d.join(nxt, [*keys, b], "left")
            .withColumn(out, F.coalesce(F.col("__lead"), F.col("__next_first")))
            .drop(b, "__lead", "__next_first"))


def validity_from_lag_desc(df: DataFrame, keys: Sequence[str], ts: str, valid_from: str = "valid_from",
                           default=None, corrected: bool = False, tie_break: Sequence[str] = ()) -> DataFrame:
    """F7 with the reference's quirk (N7): ``LAG(ts) OVER (ORDER BY ts DESC)``
    gives each version the *later* neighbour's timestamp as ``valid_from``.
    With ``corrected=True`` the earlier neighbour (``LEAD`` over DESC) is used.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(), *[F.col(c).desc() for c in tie_break])
    prev = F.lead(F.col(ts)).over(w) if corrected else F.lag(F.col(ts)).over(w)
    if default is not None:
        prev = F.coalesce(prev, F.lit(default))
    return df.withColumn(valid_from, prev)
