"""Connected components of an edge table, with joins only (alternating large-star and small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import stored


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: each node sends its neighbours (above it, or below it and itself) to the
    smallest node it knows.  Minima combine before the shuffle, so a hub with many edges is cheap;
    the join back is on edges and splits if one node's edges are skewed."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.join(low, "u")
    if larger:
        out = out.where("v > u").select("v", "m")
    else:
        out = out.select("v", "m").unionByName(low.select(F.col("u").alias("v"), "m"))
    return out.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach; nodes without a link are left out.

    Edges are kept as (u, v) with u > v.  Every round is written to the shared folder, so plans
    stay short and a lost executor costs one round.  The rounds end when every edge points at a
    root, which takes O(log^2 n) rounds.
    """
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_stars(_stars(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
