"""Calendar arithmetic against an explicit ``as_of`` date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month shift, clamped to month end (same rule as SQL)."""
    m = d.month - 1 + n
    y, m = d.year + m // 12, m % 12 + 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28,
            31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1]
    return dt.date(y, m, min(d.day, last))


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def period_bounds(period: dt.date) -> tuple[dt.date, dt.date]:
    """[first day of month, first day of next month)."""
    start = month_start(period)
    return start, add_months(start, 1)


def in_period(ts: Column, period: dt.date) -> Column:
    """Range predicate (not a function on the column) so parquet min/max
    statistics and partition pruning apply."""
    start, end = period_bounds(period)
    return (ts >= F.lit(start)) & (ts < F.lit(end))


def whole_years(later: Column, earlier: Column) -> Column:
    """Completed years between two dates (SQL AGE(...) year part)."""
    return (F.year(later) - F.year(earlier)
            - F.when(F.month(later) * 100 + F.dayofmonth(later)
                     < F.month(earlier) * 100 + F.dayofmonth(earlier), 1).otherwise(0))


def month_diff(later: Column, earlier: Column) -> Column:
    """Calendar months between two dates, day of month ignored."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
