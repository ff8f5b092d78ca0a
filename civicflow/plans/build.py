"""Assemble the silver and gold products for one run.

The clean silver table feeds both dimensions and the fact, so it is written
once to a shared folder and read back (three readers, one computation), and
the dimensions are written before the fact build, so the planner knows their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.plans.enriched import enrich
from civicflow.plans.staging import base, clean
from civicflow.plans.star import dim_borough, dim_request_type, fact_requests
from civicflow.session import scratch_path
from civicflow.sources.seeds import load_seed


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back
    (cuts lineage; the read-back carries real file-size statistics)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


class GoldBuild:
    """Silver + gold products of one run over a bronze DataFrame."""

    def __init__(self, spark: SparkSession, bronze: DataFrame, as_of: str, persist: bool = True,
                 target_fact: DataFrame | None = None, full_refresh: bool = False):
        self.spark = spark
        self.as_of = as_of
        self.clean = clean(base(bronze))
        if persist:
            self.clean = materialize(self.clean, "silver_clean")
        self.enriched = enrich(self.clean, as_of)
        self.dim_b = dim_borough(self.clean, load_seed(spark, "borough_lookup"), as_of)
        self.dim_t = dim_request_type(self.clean, load_seed(spark, "complaint_type_lookup"), as_of)
        if persist:
            self.dim_b = materialize(self.dim_b, "dim_borough")
            self.dim_t = materialize(self.dim_t, "dim_request_type")
        self.fact = fact_requests(self.enriched, self.dim_b, self.dim_t, as_of, target=target_fact,
                                  full_refresh=full_refresh)
