"""Gold star schema: P4 borough dimension, P5 request-type dimension, P6 fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.fixed_values import DEFAULT_CATEGORY, UNKNOWN, UNKNOWN_BOROUGH_CODE
from civicflow.functions import surrogate_key
from civicflow.operators.contracts import CONTRACTS, apply_contract
from civicflow.operators.incremental import merge_upsert, since
from civicflow.operators.lookup import enrich_left, resolve_fk


# Columns of P3 that the fact replaces by keys or leaves out.
NOT_IN_FACT = ("complaint_type", "complaint_descriptor", "borough", "street_name", "city", "source_filename", "source_relation")


def _literal_row(spark, **cols) -> DataFrame:
    """F16: a one-row relation with explicit types."""
    return spark.range(1).select(*[F.lit(v).cast(t).alias(k) for k, (v, t) in cols.items()])


def dim_borough(clean_df: DataFrame, borough_seed: DataFrame, as_of: str) -> DataFrame:
    """Observed boroughs + seed metadata + the ``Unknown`` sentinel.

    ``distinct`` is a partial/final hash aggregate: each map task emits each
    borough once, so a borough holding a third of all rows costs nothing extra.
    """
    observed = clean_df.filter(F.col("borough").isNotNull()).select(F.col("borough").alias("borough_name")).distinct()
    meta = borough_seed.select("borough_name", "borough_code", "county_name", "population_2020", "area_sq_mi")
    joined = enrich_left(observed, meta, "borough_name")
    unknown = _literal_row(clean_df.sparkSession, borough_name=(UNKNOWN, "string"),
                           borough_code=(UNKNOWN_BOROUGH_CODE, "string"), county_name=(UNKNOWN, "string"),
                           population_2020=(None, "decimal(10,0)"), area_sq_mi=(None, "decimal(6,2)"),
                           is_missing_metadata=(False, "boolean"))
    u = joined.unionByName(unknown)
    area = F.col("area_sq_mi")
    out = u.select(
        surrogate_key("borough_name").alias("borough_sk"),
        "borough_name", "borough_code", "county_name", "population_2020", "area_sq_mi",
        F.when(area.isNotNull() & (area > 0), F.round(F.col("population_2020") / area, 0))
         .alias("population_density_per_sq_mi"),
        "is_missing_metadata",
        F.lit(as_of).cast("timestamp_ntz").alias("dim_loaded_at"),
    )
    return apply_contract(out, CONTRACTS["dim_borough"])


def dim_request_type(clean_df: DataFrame, type_seed: DataFrame, as_of: str) -> DataFrame:
    """P5: observed request types (NULL dropped) + seed defaults + the ``Unknown`` sentinel."""
    observed = clean_df.filter(F.col("complaint_type").isNotNull()).select("complaint_type").distinct()
    joined = enrich_left(observed, type_seed, "complaint_type")
    defaulted = joined.select(
        "complaint_type",
        F.coalesce(F.col("category"), F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.coalesce(F.col("is_quality_of_life"), F.lit(False)).alias("is_quality_of_life"),
        F.coalesce(F.col("is_emergency"), F.lit(False)).alias("is_emergency"),
        "is_missing_metadata")
    unknown = _literal_row(clean_df.sparkSession, complaint_type=(UNKNOWN, "string"),
                           category=(DEFAULT_CATEGORY, "string"), is_quality_of_life=(False, "boolean"),
                           is_emergency=(False, "boolean"), is_missing_metadata=(False, "boolean"))
    u = defaulted.unionByName(unknown)
    out = u.select(surrogate_key("complaint_type").alias("complaint_type_sk"), "complaint_type", "category",
                   "is_quality_of_life", "is_emergency", "is_missing_metadata",
                   F.lit(as_of).cast("timestamp_ntz").alias("dim_loaded_at"))
    return apply_contract(out, CONTRACTS["dim_request_type"])


def fact_increment(enriched: DataFrame, dim_b: DataFrame, dim_t: DataFrame, as_of: str,
                   target: DataFrame | None = None, full_refresh: bool = False, mark: str | None = None) -> DataFrame:
    """The rows one run of P6 writes: new/changed requests with resolved keys."""
    e = since(enriched, target, "extracted_at", full_refresh=full_refresh, mark=mark)
    e = resolve_fk(e, dim_b, "borough", "borough_name", "borough_sk", UNKNOWN)
    e = resolve_fk(e, dim_t, "complaint_type", "complaint_type", "complaint_type_sk", UNKNOWN)
    e = e.withColumn("complaint_sk", surrogate_key("complaint_id")) \
         .withColumn("fct_loaded_at", F.lit(as_of).cast("timestamp_ntz"))
    return apply_contract(e.drop(*NOT_IN_FACT), CONTRACTS["fact_requests"])


def fact_requests(enriched: DataFrame, dim_b: DataFrame, dim_t: DataFrame, as_of: str,
                  target: DataFrame | None = None, full_refresh: bool = False) -> DataFrame:
    """The fact after this run: ``target`` merged with the run's increment on ``complaint_id``."""
    inc = fact_increment(enriched, dim_b, dim_t, as_of, target, full_refresh)
    if target is None or full_refresh:
        return inc
    return merge_upsert(target, inc, ["complaint_id"])
