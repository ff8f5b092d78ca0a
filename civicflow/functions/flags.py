"""Boolean status / presence flags (X20, X21, F15).  Never NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.fixed_values import OPEN_STATUSES, RESOLVED_STATUSES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _bool(cond: Column) -> Column:
    # CASE WHEN cond THEN true ELSE false: a NULL condition is false.
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def is_resolved(status: Column | str, closed_at: Column | str) -> Column:
    """Status is a resolved state and a close time exists."""
    return _bool(_col(status).isin(*RESOLVED_STATUSES) & _col(closed_at).isNotNull())


def is_open(status: Column | str, closed_at: Column | str) -> Column:
    """Status is an open state, or there is no close time."""
    return _bool(_col(status).isin(*OPEN_STATUSES) | _col(closed_at).isNull())


def has_any(*cols: Column | str) -> Column:
    """at least one of the columns is present."""
    cond = None
    for c in cols:
        cond = _col(c).isNotNull() if cond is None else cond | _col(c).isNotNull()
    return _bool(cond)


def has_value(c: Column | str) -> Column:
    return _bool(_col(c).isNotNull())
