"""Dimension lookups: J1-J5 and the lookup-or-sentinel operator J4.

No join carries a hint: the planner broadcasts a side by its measured file size, AQE
converts a join when a shuffled side turns out small, and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_left(observed: DataFrame, meta: DataFrame, key: str, meta_key: str | None = None,
                flag: str = "is_missing_metadata") -> DataFrame:
    """J1 + F14: left join observed keys to metadata and flag keys with no metadata."""
    m = meta.withColumnRenamed(meta_key or key, "__meta_key")
    joined = observed.join(m, observed[key] == F.col("__meta_key"), "left")
    return joined.withColumn(flag, F.col("__meta_key").isNull()).drop("__meta_key")


def resolve_fk(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, sentinel: str) -> DataFrame:
    """J4 = J2 + J3 + F9: add ``sk`` from ``dim`` for ``fact_key``; unmatched or NULL
    keys get the sentinel row's key.

    The sentinel key is a scalar subquery over the dimension (evaluated once);
    more than one sentinel row fails the query, and a missing sentinel leaves
    the key NULL, which the fact's not-null contract then rejects.
    """
    lookup = dim.select(F.col(dim_key).alias("__nk"), F.col(sk).alias("__sk"))
    sentinel_sk = dim.filter(F.col(dim_key) == F.lit(sentinel)).select(F.col(sk)).scalar()
    joined = fact.join(lookup, fact[fact_key] == F.col("__nk"), "left")
    return joined.withColumn(sk, F.coalesce(F.col("__sk"), sentinel_sk)).drop("__nk", "__sk")


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Inner join of a fact to dimensions on their surrogate keys."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, key, "inner")
    return out


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (left anti join)."""
    p = parent.select(F.col(pk).alias("__pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("__pk"), "left_anti")
