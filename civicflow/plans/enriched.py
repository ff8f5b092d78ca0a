"""Enriched requests (date parts, durations, flags, age bucket), 1:1 with P2."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.functions import (age_bucket, day_diff, day_name, has_any, has_value, hour_diff,
                                 is_open, is_resolved, month_start, week_start)

ENRICHED_COLUMNS = (
    "complaint_id", "created_at", "closed_at", "resolution_updated_at", "agency_code", "agency_name",
    "complaint_type", "complaint_descriptor", "status", "resolution_description", "incident_zip",
    "incident_address", "street_name", "city", "borough", "community_board", "council_district",
    "latitude", "longitude", "submission_channel", "created_date", "created_month", "created_week",
    "created_year", "created_hour", "created_day_of_week", "response_time_hours", "response_time_days",
    "is_resolved", "is_open", "days_since_created", "complaint_age_bucket", "has_geolocation",
    "has_borough", "extracted_at", "source_filename", "source_relation")


def enrich(clean_df: DataFrame, as_of: str) -> DataFrame:
    """Narrow transformation only (no shuffle).  ``as_of`` replaces "now" so
    ages are reproducible; durations are NULL unless ``closed_at >= created_at``."""
    created, closed = F.col("created_at"), F.col("closed_at")
    valid_close = closed.isNotNull() & (closed >= created)
    age = day_diff(created, F.lit(as_of).cast("timestamp_ntz"))
    out = clean_df.select(
        *[c for c in clean_df.columns if c not in ("extracted_at", "source_filename", "source_relation")],
        F.to_date(created).alias("created_date"),
        month_start(created).alias("created_month"),
        week_start(created).alias("created_week"),
        F.year(created).alias("created_year"),
        F.hour(created).alias("created_hour"),
        day_name(created).alias("created_day_of_week"),
        F.when(valid_close, hour_diff(created, closed)).alias("response_time_hours"),
        F.when(valid_close, day_diff(created, closed)).alias("response_time_days"),
        is_resolved("status", closed).alias("is_resolved"),
        is_open("status", closed).alias("is_open"),
        age.alias("days_since_created"),
        age_bucket(age).alias("complaint_age_bucket"),
        has_any("latitude", "longitude").alias("has_geolocation"),
        has_value("borough").alias("has_borough"),
        "extracted_at", "source_filename", "source_relation",
    )
    return out.select(*ENRICHED_COLUMNS)
