"""Typed CSV seeds.  Seeds are small static lookups (tens of rows).

A packaged seed is parsed on the driver and travels in the plan, so executors need no
file; a seed given by path is read by Spark from that (shared) path.
"""

from __future__ import annotations

import csv
import os
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

SEED_DIR = os.path.join(os.path.dirname(__file__), "seed_files")

# Declared seed column types (Spark DDL).
SEED_SCHEMAS = {
    "borough_lookup": "borough_name string, borough_code string, county_name string, "
                      "population_2020 decimal(10,0), area_sq_mi decimal(6,2)",
    "complaint_type_lookup": "complaint_type string, category string, is_quality_of_life boolean, "
                             "is_emergency boolean",
}

# Declared maximum string lengths (varchar(n)); checked by ``plans.checks.seed_length_checks``.
SEED_LENGTHS = {
    "borough_lookup": {"borough_name": 50, "borough_code": 2, "county_name": 50},
    "complaint_type_lookup": {"complaint_type": 100, "category": 50},
}


def seed_rows(name: str) -> list[dict]:
    """The packaged rows of a seed as text."""
    with open(os.path.join(SEED_DIR, f"{name}.csv"), newline="") as fh:
        return list(csv.DictReader(ln for ln in fh if not ln.startswith("#") and ln.strip()))


def _typed(text: str, type_: str):
    if text == "":
        return None
    if type_ == "boolean":
        return {"true": True, "false": False}[text.strip().lower()]
    return Decimal(text) if type_.startswith("decimal") else text


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed with its declared schema; a value that doesn't fit its type fails the load."""
    if path is not None:
        return (spark.read.schema(SEED_SCHEMAS[name]).option("header", True).option("comment", "#")
                .option("mode", "FAILFAST").csv(path))
    types = [c.strip().split(" ", 1) for c in SEED_SCHEMAS[name].replace("decimal(10,0)", "decimal").replace("decimal(6,2)", "decimal").split(", ")]
    rows = [tuple(_typed(r[c], t) for c, t in types) for r in seed_rows(name)]
    return spark.createDataFrame(rows, SEED_SCHEMAS[name])
