"""Q8: source freshness against an ``as_of`` time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.fixed_values import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS


def freshness(df: DataFrame, loaded_at: str, as_of: str, warn_hours: int = FRESHNESS_WARN_HOURS,
              error_hours: int = FRESHNESS_ERROR_HOURS, known_max: str | None = None) -> DataFrame:
    """One row: newest load time, its age in seconds (second boundaries crossed,
    as the warehouse's ``datediff(second, ...)``), and pass / warn / error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    mx = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    if known_max is not None:
        # Newest load already recorded (e.g. a stored high-water mark): only the
        # rows loaded since then need scanning.
        mx = mx.select(F.greatest(F.col("max_loaded_at"), F.lit(known_max).cast("timestamp_ntz"))
                       .alias("max_loaded_at"))
    secs = lambda c: F.floor(F.unix_micros(c.cast("timestamp")) / 1_000_000)
    age_s = secs(now) - secs(F.col("max_loaded_at"))
    return mx.select(
        "max_loaded_at",
        age_s.cast("long").alias("age_seconds"),
        F.when(F.col("max_loaded_at").isNull(), "error")
         .when(age_s > error_hours * 3600, "error")
         .when(age_s > warn_hours * 3600, "warn")
         .otherwise("pass").alias("status"))
