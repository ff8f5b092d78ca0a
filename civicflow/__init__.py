"""civicflow: service-request analytics as Spark DataFrame / SQL / Structured Streaming jobs.

Layers: landed JSON files -> bronze (variant rows + file lineage) -> silver
(flattened, cleaned, deduplicated, enriched, type-2 history) -> gold (star
schema merged incrementally, daily mart).  Every product is a function from
DataFrames to a DataFrame, so Catalyst sees and optimises the whole plan.
"""

from civicflow.session import get_session, scratch_path  # noqa: F401

__all__ = ["get_session", "scratch_path"]
