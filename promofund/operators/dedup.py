"""De-duplication and source merging.

Ties are arbitrary in the reference; every operator here appends a total
order (``tie_break``) so reruns and other engines pick the same row.
``row_number() == 1`` plans as a WindowGroupLimit below the shuffle, so each
task drops losing rows before they are exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top1(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
         tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` + ``tie_break``.

    ``order`` items are Columns with explicit direction and null placement
    (``F.col('ts').desc_nulls_last()``) or names (ascending, nulls first).
    Keys may be computed columns (F4).
    """
    w = Window.partitionBy(*_order(keys)).orderBy(*_order(order), *_order(tie_break))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """newest row per key by ``ts`` DESC (NULL timestamps last)."""
    return top1(df, keys, [F.col(ts).desc_nulls_last()], tie_break)


def latest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """the whole row with the greatest ``order`` values (nulls lowest) per
    ``keys``, which may be computed columns such as a day.

    An aggregate instead of a row number: every task keeps one row per key
    before the shuffle, so no task sorts a hot key. Rows equal in ``order``
    are settled by ``columns``, field by field."""
    best = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], *columns)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in columns])


def priority_dedupe(df: DataFrame, keys: Sequence[str], priority: str = "src_priority",
                    tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """lowest ``priority`` wins per key (source precedence)."""
    return top1(df, keys, [F.col(priority).asc_nulls_last()], tie_break)


def union_sources(frames: Sequence[tuple[DataFrame, str, int]], src_col: str = "src",
                  priority_col: str | None = "src_priority") -> DataFrame:
    """UNION ALL of several sources by column name.

    Missing columns are padded with typed NULLs (``allowMissingColumns``);
    each side is tagged with its source name and priority literal.
    """
    out = None
    for df, name, prio in frames:
        tagged = df.withColumn(src_col, F.lit(name))
        if priority_col:
            tagged = tagged.withColumn(priority_col, F.lit(prio).cast("bigint"))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    """H2: UNION DISTINCT by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


def merge_latest(frames: Sequence[tuple[DataFrame, str, int]], keys: Sequence[str], ts: str,
                 payload_keys: Sequence[str] | None = None,
                 tie_break: Sequence[str | Column] = ()) -> DataFrame:
    """L1–L3 shape: union two generations of a source, keep the newest row per
    key. When ``payload_keys`` is given, the winner's key + timestamp is joined
    back to every source on ``payload_keys`` + ``ts`` (D15) — the reference's
    recover-payload step; NULL keys never match there (N17)."""
    merged = union_sources(frames)
    win = latest_per_key(merged, keys, ts, tie_break)
    if payload_keys is None:
        return win
    winners = win.select(*payload_keys, ts, "src")
    out = None
    for df, name, _ in frames:
        part = winners.where(F.col("src") == name).drop("src").join(df, [*payload_keys, ts], "inner")
        part = part.withColumn("src", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def merge_versions(sources: Sequence[tuple[str, DataFrame]], keys: Sequence[str], ts: str, payload: Sequence[str],
                   src_col: str = "src") -> DataFrame:
    """L2/L3 (H1, F1, D15, C26, N17): the newest version per ``keys`` over all
    sources, with its payload recovered from the sources.

    As the reference's UNION ALL of keys, row pick and LEFT JOIN back on keys
    and time: NULL keys form groups like any value, so such a key is listed
    once, but they equal nothing in the join back, so its payload is NULL;
    several rows of one source at the winning time fan out; a column comes from
    the first source that has a row with a value there. Sources may lack payload columns.

    The joins are not done: a window marks the rows at the newest time and one
    aggregate on the same keys puts each source's rows beside each other, so all
    sources are shuffled once. A group is the versions of one key at one time.
    """
    fields = [c for c in payload if any(c in df.columns for _, df in sources)]
    types = {c: next(df.schema[c].dataType for _, df in sources if c in df.columns) for c in fields}
    both = None
    for n, (name, df) in enumerate(sources):
        cols = [F.col(c).cast(types[c]).alias(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in fields]
        rows = df.select(*keys, ts, F.lit(n).alias("__n"), F.struct(*cols, F.lit(name).alias(src_col)).alias("__row"))
        both = rows if both is None else both.unionByName(rows)
    return newest_beside(both, keys, ts, [*fields, src_col], len(sources))


def newest_beside(versions: DataFrame, keys: Sequence[str], ts: str, fields: Sequence[str], n_sources: int) -> DataFrame:
    """``merge_versions`` on sources that are one frame already: keys, ts, the
    source's number ``__n`` and its columns ``__row``, a struct of ``fields``."""
    newest = F.max(ts).over(Window.partitionBy(*keys))
    at = versions.withColumn("__newest", newest).where(F.col(ts).eqNullSafe(F.col("__newest")))
    matches = F.col(ts).isNotNull()
    for k in keys:
        matches = matches & F.col(k).isNotNull()
    sides = [F.collect_list(F.when((F.col("__n") == n) & matches, F.col("__row"))).alias(f"__s{n}") for n in range(n_sources)]
    out = at.groupBy(*keys, ts).agg(*sides)
    for n in range(n_sources):
        out = out.withColumn(f"__s{n}", F.explode_outer(f"__s{n}"))
    return out.select(*keys, ts, *[F.coalesce(*[F.col(f"__s{n}.{c}") for n in range(n_sources)]).alias(c) for c in fields])
