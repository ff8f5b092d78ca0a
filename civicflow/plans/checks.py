"""Per-layer check suites."""

from __future__ import annotations

from pyspark.sql import DataFrame

from civicflow.fixed_values import (AGE_BUCKET_LABELS, BOROUGH_NAMES, ENRICHED_STATUSES, STAGING_STATUSES,
                                    UNKNOWN)
from civicflow.operators import quality as q
from civicflow.sources.seeds import SEED_LENGTHS


def source_checks() -> list[q.Check]:
    return [q.not_null("_extracted_at"), q.not_null("filename")]


def staging_checks() -> list[q.Check]:
    return [q.not_null("complaint_id"), q.unique("complaint_id"), q.not_null("created_at"),
            q.accepted_values("status", STAGING_STATUSES, severity="warn"),
            q.accepted_values("borough", BOROUGH_NAMES, where="borough is not null"),
            q.not_null("extracted_at")]


def enriched_checks() -> list[q.Check]:
    bools = [(c, (True, False)) for c in ("is_resolved", "is_open", "has_geolocation", "has_borough")]
    out = [q.unique("complaint_id"), q.not_null("complaint_id"), q.not_null("created_at"),
           q.not_null("created_date"), q.not_null("created_month"), q.not_null("created_year"),
           q.expression_is_true(">= 0", "response_time_hours", where="response_time_hours is not null"),
           q.expression_is_true(">= 0", "response_time_days", where="response_time_days is not null")]
    for c, vals in bools[:2]:
        out += [q.not_null(c), q.accepted_values(c, vals)]
    out += [q.expression_is_true(">= 0", "days_since_created"),
            q.not_null("complaint_age_bucket"), q.accepted_values("complaint_age_bucket", AGE_BUCKET_LABELS)]
    for c, vals in bools[2:]:
        out += [q.not_null(c), q.accepted_values(c, vals)]
    out += [q.accepted_values("status", ENRICHED_STATUSES, where="status is not null"),
            q.expression_is_true("closed_at >= created_at", where="closed_at is not null",
                                 name="closing_not_before_creation"),
            q.expression_is_true("not (is_open and is_resolved)", severity="warn",
                                 name="open_excludes_resolved"),
            q.expression_is_true("(is_resolved and response_time_hours is not null) or "
                                 "(not is_resolved and response_time_hours is null)", severity="warn",
                                 name="response_time_iff_resolved")]
    return out


def dim_borough_checks() -> list[q.Check]:
    return [q.not_null("borough_sk"), q.unique("borough_sk"), q.unique("borough_name"), q.not_null("borough_name"),
            q.accepted_values("borough_name", (*BOROUGH_NAMES, UNKNOWN))]


def dim_type_checks() -> list[q.Check]:
    return [q.unique("complaint_type_sk"), q.not_null("complaint_type_sk"), q.unique("complaint_type"),
            q.not_null("complaint_type"), q.not_null("category")]


def fact_checks(dim_b: DataFrame, dim_t: DataFrame, enriched: DataFrame) -> list[q.Check]:
    return [q.unique("complaint_sk"), q.not_null("complaint_sk"), q.not_null("borough_sk"),
            q.relationships("borough_sk", dim_b, "borough_sk"), q.not_null("complaint_type_sk"),
            q.relationships("complaint_type_sk", dim_t, "complaint_type_sk"), q.unique("complaint_id"),
            q.not_null("complaint_id"), q.not_null("created_at"), q.equal_rowcount(enriched)]


def mart_checks() -> list[q.Check]:
    return [q.not_null("created_date"), q.not_null("borough_name"), q.not_null("category"),
            q.not_null("total_complaints"), q.expression_is_true(">0", "total_complaints"),
            q.unique_combination(("created_date", "borough_name", "category"))]


def seed_length_checks(name: str) -> list[q.Check]:
    """Declared ``varchar(n)`` lengths of a seed's string columns."""
    return [q.expression_is_true(f"length({col}) <= {n}", where=f"{col} is not null", name="max_length")
            for col, n in SEED_LENGTHS[name].items()]


def borough_seed_checks() -> list[q.Check]:
    return [q.unique("borough_name"), q.not_null("borough_name"), q.accepted_values("borough_name", BOROUGH_NAMES),
            q.unique("borough_code"), q.not_null("borough_code"), q.not_null("county_name"),
            q.not_null("population_2020"), *seed_length_checks("borough_lookup")]


def type_seed_checks() -> list[q.Check]:
    return [q.unique("complaint_type"), q.not_null("complaint_type"), q.not_null("category"),
            q.not_null("is_quality_of_life"), q.not_null("is_emergency"), *seed_length_checks("complaint_type_lookup")]


def seed_coverage_checks(borough_seed: DataFrame | None, type_seed: DataFrame | None) -> list[q.Check]:
    return [q.relationships("borough", borough_seed, "borough_name", severity="warn"),
            q.relationships("complaint_type", type_seed, "complaint_type", severity="warn")]


def suite(df: DataFrame, checks: list[q.Check], table: str) -> DataFrame:
    from pyspark.sql import functions as F
    return q.run_checks(df, checks).select(F.lit(table).alias("table"), "*")
