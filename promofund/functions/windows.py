"""Date windows (B1–B9): the control logic of every settlement job.

Everything here returns a ``Column`` built from built-in functions, so a
window can be evaluated for one run date (literals, pushed into the scan) or
for a whole column of run dates (one pass, no Python in the plan).
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


_ISO_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def _c(x) -> Column:
    """Column, date, ISO date string (literal) or column name."""
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x)
    if isinstance(x, str):
        return F.to_date(F.lit(x)) if _ISO_DATE.match(x) else F.col(x)
    raise TypeError(f"expected a Column, date, ISO string or column name, got {type(x)!r}")


# ---------------------------------------------------------------- B1 / B2 / B3
def week_monday(d) -> Column:
    """Monday of the ISO week of ``d`` (``trunc`` weeks start on Monday)."""
    return F.trunc(_c(d), "week")


def month_first(d) -> Column:
    """First day of the month of ``d``."""
    return F.trunc(_c(d), "month")


def is_first_not_monday(d) -> Column:
    """B2: the run date is the 1st of a month and not a Monday."""
    d = _c(d)
    return (F.dayofmonth(d) == 1) & (F.weekday(d) != 0)


def is_first_monday_after_first(d) -> Column:
    """B2: a Monday on the 2nd..7th of the month (strictly after the 1st)."""
    d = _c(d)
    first = month_first(d)
    return (F.weekday(d) == 0) & (d > first) & (d <= F.date_add(first, 6))


def settlement_window(d) -> Column:
    """The settlement window ``struct(start, end)`` for run date ``d``.

    * 1st of the month, not a Monday -> [Monday of that week, last day of month]
    * Monday on the 2nd..7th          -> [1st of month, day before]
    * otherwise                       -> previous Monday..Sunday
    """
    d = _c(d)
    monday = week_monday(d)
    fnm = is_first_not_monday(d)
    fma = is_first_monday_after_first(d)
    start = (F.when(fnm, monday)
             .when(fma, month_first(d))
             .otherwise(F.date_sub(monday, 7)))
    end = (F.when(fnm, F.last_day(d))
           .when(fma, F.date_sub(d, 1))
           .otherwise(F.date_sub(monday, 1)))
    return F.struct(start.alias("start_date"), end.alias("end_date"))


def settlement_window_literal(run_date: _dt.date) -> tuple[_dt.date, _dt.date]:
    """B3 for a single run, evaluated on the driver so the bounds reach the
    scan as literals (static partition pruning instead of a join to a 1-row CTE)."""
    monday = run_date - _dt.timedelta(days=run_date.weekday())
    first = run_date.replace(day=1)
    if run_date.day == 1 and run_date.weekday() != 0:
        nxt = (first.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
        return monday, nxt - _dt.timedelta(days=1)
    if run_date.weekday() == 0 and first < run_date <= first + _dt.timedelta(days=6):
        return first, run_date - _dt.timedelta(days=1)
    return monday - _dt.timedelta(days=7), monday - _dt.timedelta(days=1)


# ---------------------------------------------------------------- B4
def date_array(start, end) -> Column:
    """Every day in ``[start, end]``; empty when start > end.

    ``sequence`` counts down for start > end, so the guard is required (N1).
    """
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e)).otherwise(F.array().cast("array<date>"))


# ---------------------------------------------------------------- B5
@dataclass(frozen=True)
class LoadMode:
    """How much of a date-partitioned source a run reads.

    mode: ``incremental`` (run_date - look_back .. run_date), ``backfill``
    (start .. end chunk) or ``full``.  ``pad`` widens both ends by that many
    days (B5a, UTC vs local dates); ``month_grain`` truncates both bounds to
    months (B5b); ``upper_only`` keeps only the upper bound (B5c).
    """
    mode: str = "incremental"
    run_date: _dt.date | None = None
    look_back_days: int = 7
    backfill_start: _dt.date | None = None
    backfill_end: _dt.date | None = None
    pad: int = 0
    month_grain: bool = False
    upper_only: bool = False

    def bounds(self) -> tuple[_dt.date | None, _dt.date | None]:
        if self.mode == "full":
            return None, None
        if self.mode == "incremental":
            if self.run_date is None:
                raise ValueError("incremental mode needs run_date")
            lo = self.run_date - _dt.timedelta(days=self.look_back_days + self.pad)
            hi = self.run_date + _dt.timedelta(days=self.pad)
        elif self.mode == "backfill":
            if self.backfill_start is None or self.backfill_end is None:
                raise ValueError("backfill mode needs backfill_start and backfill_end")
            lo = self.backfill_start - _dt.timedelta(days=self.pad)
            hi = self.backfill_end + _dt.timedelta(days=self.pad)
        else:
            raise ValueError(f"unknown load mode {self.mode!r}")
        if self.month_grain:
            lo, hi = lo.replace(day=1), hi.replace(day=1)
        if self.upper_only:
            lo = None
        return lo, hi

    def predicate(self, column: str | Column) -> Column:
        """Literal-bounded predicate, pushed into the scan by Catalyst."""
        col = F.col(column) if isinstance(column, str) else column
        lo, hi = self.bounds()
        if lo is None and hi is None:
            return F.lit(True)
        if lo is None:
            return col <= F.lit(hi)
        return col.between(F.lit(lo), F.lit(hi))


def load_window(run_date, look_back_days: int = 7, pad: int = 0, month_grain: bool = False) -> Column:
    """B5/B5a/B5b for a column of run dates: ``struct(lo, hi)`` of the
    incremental look-back window, widened by ``pad`` days, optionally
    truncated to month starts."""
    d = _c(run_date)
    lo = F.date_sub(d, look_back_days + pad)
    hi = F.date_add(d, pad)
    if month_grain:
        lo, hi = F.trunc(lo, "month"), F.trunc(hi, "month")
    return F.struct(lo.alias("lo"), hi.alias("hi"))


# ---------------------------------------------------------------- B6 / B7 / B8 / B9
def rolling_horizon(order_date, run_date, window_start, months_back_run: int = 20,
                    months_back_window: int = 18) -> Column:
    """Order date >= run_date - 20 months AND >= window_start - 18 months
    (``add_months`` clamps to the month end)."""
    od = _c(order_date)
    return ((od >= F.add_months(_c(run_date), -months_back_run))
            & (od >= F.add_months(_c(window_start), -months_back_window)))


def overlaps(start, end, date_in, date_fin) -> Column:
    """An interval overlaps the fixed horizon ``[date_in, date_fin]``."""
    return (_c(start) <= _c(date_fin)) & (_c(end) >= _c(date_in))


def billing_month(period, order_date, campaign_end_date) -> Column:
    """The billing month, chosen per entity by its config ``period``
    ('order_date' | 'campaign_end_date'; anything else -> NULL)."""
    p = F.col(period) if isinstance(period, str) else period
    basis = (F.when(p == "order_date", _c(order_date))
             .when(p == "campaign_end_date", _c(campaign_end_date)))
    return F.trunc(basis, "month")


def billing_basis(period, order_date, campaign_end_date) -> Column:
    p = F.col(period) if isinstance(period, str) else period
    return (F.when(p == "order_date", _c(order_date))
            .when(p == "campaign_end_date", _c(campaign_end_date)))


def local_date(ts, tz) -> Column:
    """The local calendar day of a UTC instant."""
    tzc = F.lit(tz) if isinstance(tz, str) else tz
    return F.to_date(F.from_utc_timestamp(_c(ts), tzc))
