"""Registered queries (Spark) and their independent SQL oracles (DuckDB)."""

from civicflow.catalog.oracle import oracle_sql  # noqa: F401
from civicflow.catalog.queries import queries  # noqa: F401
