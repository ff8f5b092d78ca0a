"""Q10 / Q11: per-file quality profile of landed records and the run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions.variant import empty_string_count, record_map


PROFILE_COLUMNS = ("filename", "records", "missing_unique_key", "missing_created_date",
                   "missing_complaint_type", "missing_borough", "empty_strings", "duplicate_keys")


def _missing(v):
    # "Missing" is falsy: absent, NULL or the empty string.
    return v.isNull() | (v == "")


def file_profile(bronze: DataFrame) -> DataFrame:
    """Q10: one row per landed file.

    Each record is read once, as a map; counters are summed per (file, key) first, which also shows
    the keys that a file holds more than once, and then per file.
    """
    value = lambda k: F.col("m")[k]
    rec = bronze.select("filename", record_map("raw_data").alias("m")).select(
        "filename", F.when(~_missing(value("unique_key")), value("unique_key")).alias("k"),
        *[_missing(value(k)).alias(f"no_{k}") for k in ("created_date", "complaint_type", "borough")],
        empty_string_count("m").alias("empties"))
    keys = rec.groupBy("filename", "k").agg(
        F.count("*").alias("records"), *[F.count_if(f"no_{k}").alias(f"no_{k}") for k in ("created_date", "complaint_type", "borough")],
        F.sum("empties").alias("empties"))
    out = keys.groupBy("filename").agg(
        F.sum("records").alias("records"), F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("records"))), F.lit(0)).alias("missing_unique_key"),
        F.sum("no_created_date").alias("missing_created_date"), F.sum("no_complaint_type").alias("missing_complaint_type"),
        F.sum("no_borough").alias("missing_borough"), F.sum("empties").cast("long").alias("empty_strings"),
        F.count_if(F.col("k").isNotNull() & (F.col("records") > 1)).alias("duplicate_keys"))
    return out.select(*PROFILE_COLUMNS)


def run_summary(profile: DataFrame) -> DataFrame:
    """Q11: sums of the per-file counters (duplicates summed per file) + file total."""
    sums = [F.sum(c).cast("long").alias(c) for c in PROFILE_COLUMNS[1:]]
    return profile.agg(F.count(F.lit(1)).alias("files"), *sums)
