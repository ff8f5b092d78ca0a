"""Type-2 request history (I5 input selection + I4 snapshot)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.fixed_values import HISTORY_CHECK_COLUMNS
from civicflow.functions import json_field, parse_timestamp
from civicflow.functions.variant import has_path
from civicflow.operators.dedup import latest_per_key
from civicflow.operators.history import snapshot_check, snapshot_runs


def _deliveries(bronze: DataFrame, *extra: str) -> DataFrame:
    """Every raw row with a key: five fields parsed.  An absent key is filtered (JSON null is kept, as a path test does)."""
    raw = F.col("raw_data")
    return bronze.filter(has_path(raw, "unique_key")).select(
        json_field(raw, "unique_key").alias("complaint_id"),
        json_field(raw, "status").alias("status"),
        parse_timestamp(json_field(raw, "closed_date")).alias("closed_at"),
        json_field(raw, "resolution_description").alias("resolution_description"),
        parse_timestamp(json_field(raw, "resolution_action_updated_date")).alias("resolution_updated_at"),
        json_field(raw, "agency").alias("agency_code"),
        "filename", "_extracted_at", *extra)


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    return latest_per_key(rows, keys, order=[F.col("filename").desc_nulls_last()],
                          tiebreak=[F.col("_extracted_at").desc_nulls_last(),
                                    *[F.col(c).asc_nulls_first() for c in HISTORY_CHECK_COLUMNS]])


def history_input(bronze: DataFrame, with_filename: bool = False) -> DataFrame:
    """Latest raw row per *untrimmed* key (newest file, NULLs last), five fields parsed."""
    latest = _latest(_deliveries(bronze), ["complaint_id"])
    extra = [F.col("filename").alias("_source_filename")] if with_filename else []
    return latest.select("complaint_id", *HISTORY_CHECK_COLUMNS, *extra)


def request_history(history: DataFrame | None, bronze: DataFrame, run_at: str) -> DataFrame:
    """One snapshot run over the current bronze."""
    return snapshot_check(history, history_input(bronze), "complaint_id", HISTORY_CHECK_COLUMNS, run_at)


def newer_than_seen(open_versions: DataFrame | None, src: DataFrame) -> DataFrame:
    """``src`` without rows from an older file than the one its key's open version reflects.

    Each open version remembers its newest source file (``_source_filename``); a late delivery is
    ignored, exactly as a snapshot over all of bronze would ignore it.
    """
    if open_versions is None:
        return src
    seen = open_versions.select("complaint_id", F.col("_source_filename").alias("__seen"))
    return (src.join(seen, "complaint_id", "left")
            .filter(F.col("__seen").isNull() | (F.col("_source_filename") >= F.col("__seen"))).drop("__seen"))


def snapshot_requests(open_versions: DataFrame | None, src: DataFrame, run_at: str) -> DataFrame:
    """P8 over newly loaded bronze only: keys absent from it stay open, as with hard deletes off."""
    return snapshot_check(open_versions, src, "complaint_id", HISTORY_CHECK_COLUMNS, run_at, carry=("_source_filename",))


def rebuilt_history(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """P8 from all of bronze at once, as the runs in ``runs`` (run, mark, run_at) wrote it one after the other.

    A load belongs to the first run whose mark is not before its stamp.  Load stamps and runs are matched by
    a window over one row per stamp and run, not by a range join over the rows.
    """
    mark = runs.select(F.col("mark").cast("timestamp_ntz").alias("at"), "run", "run_at")
    stamps = bronze.select(F.col("_extracted_at").alias("at")).distinct()
    both = stamps.select("at", F.lit(None).cast("long").alias("run"), F.lit(None).cast("string").alias("run_at")).unionByName(mark)
    ahead = Window.orderBy("at", F.col("run").asc_nulls_first()).rowsBetween(0, Window.unboundedFollowing)
    next_run = F.first(F.when(F.col("run").isNotNull(), F.struct("run", "run_at")), ignorenulls=True).over(ahead)
    of = both.withColumn("of", next_run).where("run is null").select(F.col("at").alias("_extracted_at"), "of.run", "of.run_at")
    rows = _deliveries(bronze.join(of, "_extracted_at"), "run", "run_at")
    states = _latest(rows, ["complaint_id", "run"]).withColumn("_source_filename", F.col("filename"))
    return snapshot_runs(states, "complaint_id", HISTORY_CHECK_COLUMNS, newest=("filename",), carry=("_source_filename",))
