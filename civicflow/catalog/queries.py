"""Registered Spark queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them), so
its work grows with the scale factor.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civicflow.plans.build import GoldBuild, materialize
from civicflow.plans.enriched import enrich
from civicflow.plans.marts import daily_summary, median_response_by_category, monthly_trend, requests_per_100k
from civicflow.plans.staging import base, clean
from civicflow.plans.star import dim_borough, dim_request_type
from civicflow.session import JIT_DEFAULTS, apply_scale_defaults, ensure_checkpoint_dir
from civicflow.sources.seeds import load_seed
from civicflow.sources.service_requests import AS_OF, service_request_bronze

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sr_bronze(spark: SparkSession, sf_dir: str, drops=(1, 2), repaired: bool = False) -> DataFrame:
    """Bronze as a stored table, as the products read it: the fixture is derived once per query."""
    return materialize(service_request_bronze(table(spark, sf_dir, "events"), drops, repaired), "bronze")


def _prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    apply_scale_defaults(spark, JIT_DEFAULTS)
    ensure_checkpoint_dir(spark)


def q_base(spark, sf_dir):
    _prepare(spark)
    return base(sr_bronze(spark, sf_dir))


def q_clean(spark, sf_dir):
    _prepare(spark)
    return clean(base(sr_bronze(spark, sf_dir)))


def q_enriched(spark, sf_dir):
    _prepare(spark)
    return enrich(clean(base(sr_bronze(spark, sf_dir))), AS_OF)


def q_dim_borough(spark, sf_dir):
    _prepare(spark)
    return dim_borough(clean(base(sr_bronze(spark, sf_dir))), load_seed(spark, "borough_lookup"), AS_OF)


def q_dim_request_type(spark, sf_dir):
    _prepare(spark)
    return dim_request_type(clean(base(sr_bronze(spark, sf_dir))), load_seed(spark, "complaint_type_lookup"), AS_OF)


def gold(spark, sf_dir) -> GoldBuild:
    _prepare(spark)
    return GoldBuild(spark, sr_bronze(spark, sf_dir), AS_OF)


def q_fact(spark, sf_dir):
    return gold(spark, sf_dir).fact


def q_daily_summary(spark, sf_dir):
    g = gold(spark, sf_dir)
    return daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF)


def q_per_100k(spark, sf_dir):
    g = gold(spark, sf_dir)
    return requests_per_100k(g.fact, g.dim_b)


def q_median_by_category(spark, sf_dir):
    g = gold(spark, sf_dir)
    return median_response_by_category(g.fact, g.dim_t)


def q_monthly_trend(spark, sf_dir):
    g = gold(spark, sf_dir)
    return monthly_trend(daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF))


def _asked(question: str) -> Query:
    """A question in SQL over views of the gold products."""
    def run(spark, sf_dir):
        from civicflow.plans.views import ask, register
        g = gold(spark, sf_dir)
        mart = daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF)
        register({"fact": g.fact, "borough": g.dim_b, "request_type": g.dim_t, "daily": mart,
                  "requests_per_100k": requests_per_100k(g.fact, g.dim_b),
                  "median_response": median_response_by_category(g.fact, g.dim_t), "monthly_trend": monthly_trend(mart)})
        return ask(spark, question)
    return run


def queries() -> dict[str, Query]:
    from civicflow.catalog import queries_extra

    out: dict[str, Query] = {
        "p1_base": q_base,
        "p2_requests_clean": q_clean,
        "p3_requests_enriched": q_enriched,
        "p4_dim_borough": q_dim_borough,
        "p5_dim_request_type": q_dim_request_type,
        "p6_fact_requests": q_fact,
        "p7_daily_summary": q_daily_summary,
        "p9_requests_per_100k": q_per_100k,
        "p10_median_response_by_category": q_median_by_category,
        "p11_monthly_trend": q_monthly_trend,
        **{f"s8_sql_{q}": _asked(q) for q in ("per_capita", "median_by_category", "monthly_trend", "open_backlog", "busiest_day")},
    }
    out.update(queries_extra.extra())
    return out
