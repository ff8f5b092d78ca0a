"""Reporting: P7 daily summary mart and the ad-hoc BI questions P9-P11."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.contracts import CONTRACTS, apply_contract
from civicflow.operators.lookup import star_join


def daily_summary(fact: DataFrame, dim_b: DataFrame, dim_t: DataFrame, as_of: str) -> DataFrame:
    """Date x borough x category counts, resolution rate and exact response-time percentiles.

    The aggregation is hash-partial per task then final per group.  ``percentile`` keeps a value->count map
    per group (response hours are integers), so its memory is bounded by the
    number of distinct hours, not rows, even for a group holding a third of
    the data.  p50 and p90 come from one aggregate.
    """
    b = dim_b.select("borough_sk", "borough_name")
    t = dim_t.select("complaint_type_sk", "category", "is_quality_of_life", "is_emergency")
    f = fact.select("created_date", "borough_sk", "complaint_type_sk", "is_resolved", "is_open",
                    "response_time_hours")
    j = star_join(f, [(b, "borough_sk"), (t, "complaint_type_sk")])
    n = F.count(F.lit(1))
    resolved = F.count_if("is_resolved")
    pct = F.percentile(F.col("response_time_hours"), F.array(F.lit(0.5), F.lit(0.9)))
    agg = j.groupBy("created_date", "borough_name", "category").agg(
        n.alias("total_complaints"),
        resolved.alias("resolved_complaints"),
        F.count_if("is_open").alias("open_complaints"),
        F.count_if("is_quality_of_life").alias("quality_of_life_complaints"),
        F.count_if("is_emergency").alias("emergency_complaints"),
        F.round(F.lit(100).cast("decimal(4,1)") * resolved / F.nullif(n, F.lit(0)), 1).alias("pct_resolved"),
        pct.alias("__p"),
        F.max("response_time_hours").alias("max_response_hours"))
    out = agg.select(
        "*",
        F.round(F.col("__p")[0], 1).alias("median_response_hours"),
        F.round(F.col("__p")[1], 1).alias("p90_response_hours"),
        F.lit(as_of).cast("timestamp_ntz").alias("report_loaded_at")).drop("__p")
    return apply_contract(out, CONTRACTS["daily_summary"])


def requests_per_100k(fact: DataFrame, dim_b: DataFrame) -> DataFrame:
    """Requests per 100 000 residents by borough (boroughs with a population)."""
    b = dim_b.filter(F.col("population_2020").isNotNull()).select("borough_sk", "borough_name", "population_2020")
    j = star_join(fact.select("borough_sk"), [(b, "borough_sk")])
    out = j.groupBy("borough_name", "population_2020").agg(F.count(F.lit(1)).alias("total_complaints"))
    return out.withColumn(
        "complaints_per_100k",
        F.round(F.col("total_complaints") * F.lit(100000).cast("decimal(7,1)") / F.col("population_2020"), 2)
        .cast("decimal(18,2)")).orderBy(F.col("complaints_per_100k").desc())


def median_response_by_category(fact: DataFrame, dim_t: DataFrame) -> DataFrame:
    """P10: exact median response hours per category over resolved requests."""
    t = dim_t.select("complaint_type_sk", "category")
    f = fact.filter(F.col("is_resolved")).select("complaint_type_sk", "response_time_hours")
    j = star_join(f, [(t, "complaint_type_sk")])
    out = j.groupBy("category").agg(
        F.count(F.lit(1)).alias("complaints"),
        F.percentile(F.col("response_time_hours").cast("double"), F.lit(0.5)).alias("median_hours"))
    return out.orderBy(F.col("median_hours").desc())


def monthly_trend(summary: DataFrame) -> DataFrame:
    """Monthly totals and resolution rate re-aggregated from the daily mart."""
    out = summary.groupBy(F.trunc("created_date", "month").alias("month")).agg(
        F.sum("total_complaints").cast("decimal(28,0)").alias("complaints"),
        F.round(F.lit(100).cast("decimal(4,1)") * F.sum("resolved_complaints") / F.sum("total_complaints"), 1)
        .cast("decimal(10,1)").alias("pct_resolved"))
    return out.orderBy("month")
