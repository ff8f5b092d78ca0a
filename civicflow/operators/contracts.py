"""Q9: schema contracts for gold products (names, types, not-null)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DecimalType, StringType, StructField, StructType,
                               TimestampNTZType)

# The products' contracts, which consumers rely on.
# name -> ([(column, type)], not-null columns).  Column order is the contract order.
_SPECS = {
    "dim_borough": (
        [("borough_sk", "string"), ("borough_name", "string"), ("borough_code", "string"),
         ("county_name", "string"), ("population_2020", "decimal(10,0)"), ("area_sq_mi", "decimal(10,0)"),
         ("population_density_per_sq_mi", "decimal(10,0)"), ("is_missing_metadata", "boolean"),
         ("dim_loaded_at", "timestamp_ntz")],
        ("borough_sk", "borough_name", "is_missing_metadata", "dim_loaded_at")),
    "dim_request_type": (
        [("complaint_type_sk", "string"), ("complaint_type", "string"), ("category", "string"),
         ("is_quality_of_life", "boolean"), ("is_emergency", "boolean"), ("is_missing_metadata", "boolean"),
         ("dim_loaded_at", "timestamp_ntz")],
        ("complaint_type_sk", "complaint_type", "category", "is_quality_of_life", "is_emergency",
         "is_missing_metadata", "dim_loaded_at")),
    "fact_requests": (
        [("complaint_sk", "string"), ("borough_sk", "string"), ("complaint_type_sk", "string"),
         ("complaint_id", "string"), ("agency_code", "string"), ("agency_name", "string"), ("status", "string"),
         ("submission_channel", "string"), ("incident_zip", "string"), ("incident_address", "string"),
         ("community_board", "string"), ("council_district", "string"), ("latitude", "decimal(18,12)"),
         ("longitude", "decimal(18,12)"), ("created_at", "timestamp_ntz"), ("created_date", "date"),
         ("created_week", "date"), ("created_month", "date"), ("created_year", "decimal(4,0)"),
         ("created_hour", "decimal(2,0)"), ("created_day_of_week", "string"), ("closed_at", "timestamp_ntz"),
         ("resolution_updated_at", "timestamp_ntz"), ("response_time_hours", "decimal(18,2)"),
         ("response_time_days", "decimal(18,2)"), ("days_since_created", "decimal(18,0)"),
         ("is_resolved", "boolean"), ("is_open", "boolean"), ("has_geolocation", "boolean"),
         ("has_borough", "boolean"), ("complaint_age_bucket", "string"), ("resolution_description", "string"),
         ("extracted_at", "timestamp_ntz"), ("fct_loaded_at", "timestamp_ntz")],
        ("complaint_sk", "borough_sk", "complaint_type_sk", "complaint_id", "created_at", "is_resolved",
         "is_open", "has_geolocation", "has_borough", "extracted_at", "fct_loaded_at")),
    "daily_summary": (
        [("created_date", "date"), ("borough_name", "string"), ("category", "string"),
         ("total_complaints", "decimal(18,0)"), ("resolved_complaints", "decimal(18,0)"),
         ("open_complaints", "decimal(18,0)"), ("quality_of_life_complaints", "decimal(18,0)"),
         ("emergency_complaints", "decimal(18,0)"), ("pct_resolved", "decimal(5,1)"),
         ("median_response_hours", "decimal(18,1)"), ("p90_response_hours", "decimal(18,1)"),
         ("max_response_hours", "decimal(18,2)"), ("report_loaded_at", "timestamp_ntz")],
        ("created_date", "borough_name", "category", "total_complaints", "report_loaded_at")),
}

_SIMPLE_TYPES = {"string": StringType, "boolean": BooleanType, "date": DateType, "timestamp_ntz": TimestampNTZType}


def _data_type(name: str):
    """The few declared types of the contracts (no session needed)."""
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return DecimalType(int(p), int(s))
    return _SIMPLE_TYPES[name]()


class Contract:
    def __init__(self, name: str, columns: list[tuple[str, str]], not_null: tuple[str, ...]):
        self.name = name
        self.declared = columns
        self.not_null = not_null
        self.schema = StructType([StructField(c, _data_type(t), True) for c, t in columns])

    @property
    def columns(self) -> list[str]:
        return [c for c, _ in self.declared]


CONTRACTS = {name: Contract(name, cols, nn) for name, (cols, nn) in _SPECS.items()}


class ContractError(ValueError):
    pass


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns in order, cast to the declared types and
    enforce not-null per row.

    Missing and extra columns fail at plan time.  Casts run under ANSI rules (overflow fails the job); NULLs in a
    not-null column raise inside the same projection - no extra pass.
    """
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ContractError(f"{contract.name}: missing columns {missing}")
    extra = [c for c in df.columns if c not in contract.columns]
    if extra:
        raise ContractError(f"{contract.name}: unexpected columns {extra}")
    out = []
    for f in contract.schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in contract.not_null:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{contract.name}.{f.name} is NULL"))
                       .cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def contract_drift(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """(column, expected, actual) for every name/type difference (schema only, no job)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    drift = []
    for f in contract.schema.fields:
        a = actual.pop(f.name, None)
        if a != f.dataType.simpleString():
            drift.append((f.name, f.dataType.simpleString(), a or "<missing>"))
    drift.extend((name, "<absent>", t) for name, t in actual.items())
    return drift


def contract_report(df: DataFrame, contract: Contract, product: str) -> DataFrame:
    """Q9 as data: one row per product - columns, schema drift against the
    contract, and rows violating its not-null columns (one fused pass)."""
    drift = len(contract_drift(df, contract))
    nulls = None
    for c in contract.not_null:
        term = F.count_if(F.col(c).isNull())
        nulls = term if nulls is None else nulls + term
    return df.agg(nulls.cast("long").alias("not_null_failures")).select(
        F.lit(product).alias("product"), F.lit(len(df.columns)).cast("int").alias("columns"),
        F.lit(drift).cast("int").alias("drift"), "not_null_failures")
