"""Type-2 history with the check strategy (I4) and its as-of view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _scd_id(key: str, ts_col) -> F.Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")),
                             F.coalesce(ts_col.cast("string"), F.lit(""))))


def snapshot_check(history: DataFrame | None, source: DataFrame, key: str,
                   check_cols: Sequence[str], run_at: str, carry: Sequence[str] = ()) -> DataFrame:
    """One snapshot run.

    * new key -> open version (valid_from = run_at, valid_to NULL);
    * tracked column changed (NULL-safe) -> close the open version at
      ``run_at`` and open a new one;
    * unchanged -> nothing; key missing from ``source`` -> left open.

    Plan: open versions FULL-OUTER-joined to the source on the key (one
    shuffle of each side on ``key``); closed history is passed through
    untouched.  ``source`` must be unique on ``key``.

    ``carry`` columns ride along without change tracking: an open version takes
    the source's value whenever the key is present in the source.
    """
    ts = F.lit(run_at).cast("timestamp_ntz")
    cols = [key, *check_cols]
    carry = list(carry)
    src = source.select(*cols, *carry)
    new_rows = lambda df: df.select(*cols, _scd_id(key, ts).alias("scd_id"), ts.alias("updated_at"),
                                    ts.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                                    *carry)
    if history is None:
        return new_rows(src)
    closed = history.filter(F.col("valid_to").isNotNull())
    open_ = history.filter(F.col("valid_to").isNull())
    o = open_.alias("o")
    s = src.alias("s")
    j = o.join(s, F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer")
    changed = None
    for c in check_cols:
        diff = ~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
        changed = diff if changed is None else changed | diff
    has_o = F.col(f"o.{key}").isNotNull()
    has_s = F.col(f"s.{key}").isNotNull()
    j = j.withColumn("__changed", has_o & has_s & changed)
    # Open versions: kept open unless changed, in which case they are closed now.
    old = j.filter(has_o).select(
        *[F.col(f"o.{c}").alias(c) for c in cols], F.col("o.scd_id"), F.col("o.updated_at"),
        F.col("o.valid_from"), F.when(F.col("__changed"), ts).otherwise(F.lit(None).cast("timestamp_ntz"))
        .alias("valid_to"),
        *[F.when(has_s & ~F.col("__changed"), F.col(f"s.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in carry])
    # New versions: new keys and changed keys.
    fresh = new_rows(j.filter(has_s & (~has_o | F.col("__changed")))
                     .select(*[F.col(f"s.{c}").alias(c) for c in cols + carry]))
    return closed.select(*cols, *SCD_COLUMNS, *carry).unionByName(old).unionByName(fresh)


def snapshot_runs(states: DataFrame, key: str, check_cols: Sequence[str], newest: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """The history that ``snapshot_check`` gives run after run, in one pass over all runs' deliveries.

    ``states``: (key, run, run_at, tracked and carried columns, ``newest``), one row per key and run, the row that wins
    within the run.  A key's state after a run is the row with the largest ``newest`` up to it (NULLs lowest, a later
    run wins a tie), so a late delivery of an older file changes nothing.  A version starts where the state's
    tracked columns differ from the state before (NULL-safe) and ends where the next one starts.

    Windows are per key over one row per run, so their size is bounded by the number of runs.
    """
    cols = [key, *check_cols]
    by_run = Window.partitionBy(key).orderBy("run")
    rank = [x for c in newest for x in (F.col(c).isNotNull().alias(f"__has_{c}"), F.col(c).alias(f"__{c}"))]
    state = F.struct(*rank, F.col("run").alias("__run"), *check_cols, *carry)
    known = states.select(key, "run", "run_at", F.max(state).over(by_run.rowsBetween(Window.unboundedPreceding, 0)).alias("state"))
    tracked = F.struct(*[F.col(f"state.{c}") for c in check_cols])
    before = known.withColumn("__now", tracked).withColumn("__before", F.lag(tracked).over(by_run)).withColumn("__first", F.row_number().over(by_run) == 1)
    # The state's carried columns at the end of a version are those of the last run before the next one starts.
    starts = before.withColumn("__starts", F.col("__first") | ~F.col("__now").eqNullSafe(F.col("__before")))
    numbered = starts.withColumn("__version", F.sum(F.col("__starts").cast("int")).over(by_run))
    versions = numbered.groupBy(key, "__version").agg(F.min_by("__now", "run").alias("now"), F.min_by("run_at", "run").alias("run_at"),
                                                      F.min("run").alias("run"), F.max_by("state", "run").alias("last"))
    ts = F.col("run_at").cast("timestamp_ntz")
    return versions.select(key, *[F.col(f"now.{c}").alias(c) for c in check_cols], _scd_id(key, ts).alias("scd_id"), ts.alias("updated_at"),
                           ts.alias("valid_from"), F.lead(ts).over(by_run).alias("valid_to"),
                           *[F.col(f"last.{c}").alias(c) for c in carry]).select(*cols, *SCD_COLUMNS, *carry)


def as_of(history: DataFrame, t: str) -> DataFrame:
    """The version of each key that was current at time ``t``."""
    tt = F.lit(t).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= tt) & (F.col("valid_to").isNull() | (F.col("valid_to") > tt)))
