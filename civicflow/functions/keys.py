"""Deterministic hashed surrogate keys (no sequence, no coordination)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicflow.fixed_values import SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR


def surrogate_key(*cols: Column | str) -> Column:
    """md5 of the '-'-joined string casts; a NULL part becomes a fixed token."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL_TOKEN))
             for c in cols]
    joined = parts[0] if len(parts) == 1 else F.concat_ws(SURROGATE_SEPARATOR, *parts)
    return F.md5(joined)
