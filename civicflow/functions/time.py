"""Date parts and warehouse-style date differences on ``timestamp_ntz``.

All of these are plain integer / date arithmetic and need no session time
zone: differences count calendar boundaries crossed, as the warehouse does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.fixed_values import AGE_BUCKET_ELSE, AGE_BUCKETS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(_col(c)), "month")


def week_start(c: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(F.to_date(_col(c)), "week")


def day_name(c: Column | str) -> Column:
    """Three-letter English day name (``Mon``)."""
    return F.dayname(_col(c))


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Number of date boundaries between two timestamps (end - start)."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def hour_diff(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries crossed, e.g. 10:59 -> 11:01 is 1."""
    return day_diff(start, end) * 24 + (F.hour(_col(end)) - F.hour(_col(start)))


def age_bucket(days: Column | str) -> Column:
    """F8: ordered bucket CASE over an age in days."""
    d = _col(days)
    expr = None
    for upper, label in AGE_BUCKETS:
        cond = (d == upper) if upper == 0 else (d <= upper)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AGE_BUCKET_ELSE)
