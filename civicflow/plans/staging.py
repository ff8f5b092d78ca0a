"""P1 (base: typed flattening of the raw variant) and P2 (clean, deduplicated)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.fixed_values import LATITUDE_BOUNDS, LONGITUDE_BOUNDS, RECORD_KEYS
from civicflow.functions import (blank_to_null, parse_decimal, parse_timestamp, placeholder_to_null,
                                 title_case, within)
from civicflow.functions.variant import json_fields
from civicflow.operators.dedup import latest_per_key

BASE_COLUMNS = ("complaint_id", "created_at", "closed_at", "resolution_updated_at", "agency_code",
                "agency_name", "complaint_type", "complaint_descriptor", "status", "resolution_description",
                "incident_zip", "incident_address", "street_name", "city", "borough", "community_board",
                "council_district", "latitude", "longitude", "submission_channel", "extracted_at",
                "source_filename", "source_relation")

# (record key, column) for the plain string fields, in output order.
_STRING_FIELDS = (("agency", "agency_code"), ("agency_name", "agency_name"),
                  ("complaint_type", "complaint_type"), ("descriptor", "complaint_descriptor"),
                  ("status", "status"), ("resolution_description", "resolution_description"),
                  ("incident_zip", "incident_zip"), ("incident_address", "incident_address"),
                  ("street_name", "street_name"), ("city", "city"), ("borough", "borough"),
                  ("community_board", "community_board"), ("council_district", "council_district"))


def base(bronze: DataFrame) -> DataFrame:
    """23 typed columns flattened from ``raw_data`` (one pass, no shuffle).

    The variant is traversed once into a struct of all consumed keys rather
    than once per key (about 2x cheaper per row)."""
    rec = bronze.select(json_fields("raw_data", RECORD_KEYS).alias("r"), "_extracted_at", "filename",
                        "_source_relation")
    r = lambda k: F.col(f"r.{k}")
    return rec.select(
        r("unique_key").alias("complaint_id"),
        parse_timestamp(r("created_date")).alias("created_at"),
        parse_timestamp(r("closed_date")).alias("closed_at"),
        parse_timestamp(r("resolution_action_updated_date")).alias("resolution_updated_at"),
        *[r(k).alias(c) for k, c in _STRING_FIELDS],
        parse_decimal(r("latitude")).alias("latitude"),
        parse_decimal(r("longitude")).alias("longitude"),
        r("open_data_channel_type").alias("submission_channel"),
        F.col("_extracted_at").alias("extracted_at"),
        F.col("filename").alias("source_filename"),
        F.col("_source_relation").alias("source_relation"),
    )


# Winner of a complaint id: newest file name (NULLs first, as a bare DESC in the
# warehouse), then newest load, then newest creation time, then the other
# columns in order - a deterministic total order that SQL can state too.
def _dedup_order():
    return [F.col("source_filename").desc_nulls_first()]


# Tie-break columns after the load time: a total order over the remaining
# columns (rows equal on all of them are interchangeable).
TIEBREAK_COLUMNS = tuple(c for c in BASE_COLUMNS if c not in ("source_filename", "extracted_at", "created_at"))


def _dedup_tiebreak():
    return [F.col("extracted_at").desc_nulls_last(), F.col("created_at").desc_nulls_last(),
            *[F.col(c).asc_nulls_first() for c in TIEBREAK_COLUMNS]]


def cleaned_rows(base_df: DataFrame, lat_bounds=LATITUDE_BOUNDS, lon_bounds=LONGITUDE_BOUNDS) -> DataFrame:
    """Row-wise normalisation of P1 (no shuffle)."""
    return base_df.select(
        F.trim(F.col("complaint_id")).alias("complaint_id"),
        "created_at", "closed_at", "resolution_updated_at",
        blank_to_null("agency_code").alias("agency_code"),
        blank_to_null("agency_name").alias("agency_name"),
        title_case(blank_to_null("complaint_type")).alias("complaint_type"),
        title_case(blank_to_null("complaint_descriptor")).alias("complaint_descriptor"),
        title_case(blank_to_null("status")).alias("status"),
        blank_to_null("resolution_description").alias("resolution_description"),
        blank_to_null("incident_zip").alias("incident_zip"),
        blank_to_null("incident_address").alias("incident_address"),
        blank_to_null("street_name").alias("street_name"),
        blank_to_null("city").alias("city"),
        placeholder_to_null("borough").alias("borough"),
        blank_to_null("community_board").alias("community_board"),
        blank_to_null("council_district").alias("council_district"),
        within("latitude", lat_bounds).alias("latitude"),
        within("longitude", lon_bounds).alias("longitude"),
        title_case(blank_to_null("submission_channel")).alias("submission_channel"),
        "extracted_at", "source_filename", "source_relation",
    )


def latest_versions(cleaned: DataFrame) -> DataFrame:
    """Newest cleaned version per non-NULL ``complaint_id`` (before the created_at filter)."""
    return latest_per_key(cleaned, ["complaint_id"], order=_dedup_order(), tiebreak=_dedup_tiebreak(),
                          drop_null_keys=True)


def clean(base_df: DataFrame, lat_bounds=LATITUDE_BOUNDS, lon_bounds=LONGITUDE_BOUNDS) -> DataFrame:
    """Normalised, one row per ``complaint_id`` (newest file wins), with an id and a creation time.

    The dedup runs before the ``created_at`` filter, so an id whose newest
    version lacks a creation time disappears.  Shuffle: one, on ``complaint_id``.
    """
    latest = latest_versions(cleaned_rows(base_df, lat_bounds, lon_bounds))
    return latest.filter(F.col("created_at").isNotNull())
