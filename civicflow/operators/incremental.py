"""Incremental maintenance: high-water mark, keyed merge, column evolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.fixed_values import DEFAULT_WATERMARK


def high_water_mark(target: DataFrame | None, col: str, default: str = DEFAULT_WATERMARK):
    """Scalar-subquery column: ``coalesce(max(target.col), default)``."""
    default_col = F.lit(default).cast("timestamp_ntz")
    if target is None:
        return default_col
    return target.agg(F.coalesce(F.max(col), default_col)).scalar()


def since(df: DataFrame, target: DataFrame | None, col: str, default: str = DEFAULT_WATERMARK,
          full_refresh: bool = False, mark: str | None = None) -> DataFrame:
    """Rows strictly newer than the target's high-water mark.

    The first run (no target) and a full refresh (I6) take every row.  The
    mark is one scalar subquery (a partial/final ``max`` aggregate), pushed
    into the scan's filters when ``df`` is a table scan.
    """
    if target is None or full_refresh:
        return df
    if mark is not None:  # mark stored with the target table: no scan needed
        return df.filter(F.col(col) > F.lit(mark).cast("timestamp_ntz"))
    return df.filter(F.col(col) > high_water_mark(target, col, default))


def evolve_union(target: DataFrame, src: DataFrame) -> DataFrame:
    """Union by name; columns new in ``src`` are appended (NULL for old rows),
    columns missing from ``src`` stay and are NULL for new rows."""
    return target.unionByName(src, allowMissingColumns=True)


def merge_upsert(target: DataFrame | None, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched keys are replaced by the source row, others inserted.

    ``target LEFT ANTI JOIN src`` keeps untouched rows; the union adds every
    source row.  A key that the source holds twice raises, as for a MERGE.
    """
    src = unique_source(src, keys)
    if target is None:
        return src
    touched = src.select(*keys).distinct()
    kept = target.join(touched, list(keys), "left_anti").select(*target.columns)
    return evolve_union(kept, src)


def unique_source(src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``src``; reading it raises if a non-NULL key occurs twice.

    The window looks one row ahead within a key, so no group is buffered.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # A row with a NULL key matches no other one, so it gets a window of its own.
    src = src.withColumn("__alone", F.when(~known, F.monotonically_increasing_id()))
    again = F.row_number().over(Window.partitionBy(*keys, "__alone").orderBy(*keys)) > 1
    first = F.col(keys[0])
    bad = F.raise_error(F.concat(F.lit("duplicate source key: "), key)).cast(src.schema[keys[0]].dataType)
    return src.withColumn("__again", again).withColumn(keys[0], F.when(F.col("__again") & known, bad).otherwise(first)).drop("__again", "__alone")
