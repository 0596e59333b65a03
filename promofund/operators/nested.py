"""Nesting and unnesting of child rows.

``nest`` is ``collect_list(struct)`` after a hash shuffle on the parent key
(the aggregate has no map-side reduction, so the shuffle carries every child
once — the same bytes as the flat rows). Arrays are sorted so that reruns and
other engines build the same nested value. A parent whose children are all
NULL (an outer join that found none) gets an empty array, as the reference
stores NULL arrays as ``[]``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def child_struct(fields: Sequence[str | Column], present: Column | None = None) -> Column:
    """A struct of ``fields``; NULL (so dropped by ``collect_list``) when
    ``present`` is false — the conditional ARRAY_AGG ... IGNORE NULLS (E9)."""
    s = F.struct(*[F.col(f) if isinstance(f, str) else f for f in fields])
    return s if present is None else F.when(present, s)


def nest(df: DataFrame, keys: Sequence[str], name: str, fields: Sequence[str | Column],
         present: Column | None = None, sort: bool = True, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys`` with ``name`` = array of child structs
    (sorted by the struct's fields in order), plus ``extra_aggs``."""
    arr = F.collect_list(child_struct(fields, present))
    if sort:
        arr = F.array_sort(arr)
    return df.groupBy(*keys).agg(arr.alias(name), *extra_aggs)


def unnest(df: DataFrame, array_col: str, alias: str = "child", outer: bool = False,
           with_position: bool = False) -> DataFrame:
    """D17 (inner, ``explode``) / D18 (left, ``explode_outer``): one row per
    element with the struct's fields promoted to columns.

    Use the inner form when a NULL-rejecting predicate follows: Spark does not
    turn ``explode_outer`` + ``IS NOT NULL`` into an inner generate.
    """
    if with_position:
        gen = F.posexplode_outer(array_col) if outer else F.posexplode(array_col)
        out = df.select("*", gen.alias("pos", alias))
    else:
        gen = F.explode_outer(array_col) if outer else F.explode(array_col)
        out = df.select("*", gen.alias(alias))
    return out.drop(array_col).select("*", f"{alias}.*").drop(alias)


def distinct_join(arr_col: str | Column, field: str | None, sep: str = ",") -> Column:
    """``ARRAY_TO_STRING(ARRAY(SELECT DISTINCT x FROM UNNEST(a) ORDER BY x), sep)``."""
    a = F.col(arr_col) if isinstance(arr_col, str) else arr_col
    vals = F.transform(a, lambda x: x[field]) if field else a
    return F.array_join(F.array_sort(F.array_distinct(vals)), sep)
