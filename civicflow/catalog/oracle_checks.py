"""Oracle SQL for the quality, freshness and profile queries.

The expected checks of each table are listed here from the specification, as (label, column,
severity, SQL condition of a failing row), independently of ``plans/checks.py``.
"""

from __future__ import annotations

from civicflow.catalog.oracle import SRProducts, among, lit, seed_borough_values, seed_type_values
from civicflow.fixed_values import (AGE_BUCKET_LABELS, BOROUGH_NAMES, ENRICHED_STATUSES, RECORD_KEYS, STAGING_STATUSES, UNKNOWN)


def _required(*columns):
    return [("not_null", c, "error", f"{c} is null") for c in columns]


def _allowed(column, options, severity="error"):
    return ("accepted_values", column, severity, f"not ({among(column, options)})")


def _true(column, expression, label="expression_is_true", severity="error"):
    return (label, column, severity, f"not ({expression})")


def _once(*columns):
    return [("unique", c, "error", None) for c in columns]


FLAGS = (True, False)
STAGING = [*_required("complaint_id", "created_at", "extracted_at"), *_once("complaint_id"),
           _allowed("status", STAGING_STATUSES, "warn"), _allowed("borough", BOROUGH_NAMES)]
ENRICHED = [*_once("complaint_id"),
            *_required("complaint_id", "created_at", "created_date", "created_month", "created_year", "is_resolved", "is_open",
                       "complaint_age_bucket", "has_geolocation", "has_borough"),
            *[_allowed(c, FLAGS) for c in ("is_resolved", "is_open", "has_geolocation", "has_borough")],
            *[_true(c, f"{c} >= 0") for c in ("response_time_hours", "response_time_days", "days_since_created")],
            _allowed("complaint_age_bucket", AGE_BUCKET_LABELS), _allowed("status", ENRICHED_STATUSES),
            _true(None, "closed_at >= created_at", "closing_not_before_creation"),
            _true(None, "not (is_open and is_resolved)", "open_excludes_resolved", "warn"),
            _true(None, "is_resolved = (response_time_hours is not null)", "response_time_iff_resolved", "warn")]
BOROUGHS = [*_required("borough_sk", "borough_name"), *_once("borough_sk", "borough_name"), _allowed("borough_name", (*BOROUGH_NAMES, UNKNOWN))]
TYPES = [*_required("complaint_type_sk", "complaint_type", "category"), *_once("complaint_type_sk", "complaint_type")]
FACT = [*_once("complaint_sk", "complaint_id"),
        *_required("complaint_sk", "borough_sk", "complaint_type_sk", "complaint_id", "created_at")]
MART = [*_required("created_date", "borough_name", "category", "total_complaints"), _true("total_complaints", "total_complaints > 0")]
BOROUGH_SEED = [*_once("borough_name", "borough_code"), *_required("borough_name", "borough_code", "county_name", "population_2020"),
                _allowed("borough_name", BOROUGH_NAMES), *[_true(None, f"length({c}) <= {n}", "max_length")
                                                           for c, n in (("borough_name", 50), ("borough_code", 2), ("county_name", 50))]]
TYPE_SEED = [*_once("complaint_type"), *_required("complaint_type", "category", "is_quality_of_life", "is_emergency"),
             *[_true(None, f"length({c}) <= {n}", "max_length") for c, n in (("complaint_type", 100), ("category", 50))]]


def _row(table: str, label: str, column: str | None, severity: str, failures: str) -> str:
    name = "cast(null as varchar)" if column is None else lit(column)
    return (f"select {lit(table)} as \"table\", {lit(label)} as \"check\", {name} as \"column\", {lit(severity)} as severity, "
            f"cast(({failures}) as bigint) as failures")


def _missing_parents(rel: str, column: str, parent: str, key: str) -> str:
    return f"select count(*) from ({rel}) r anti join ({parent}) p on r.{column} = p.{key} where r.{column} is not null"


def checks_sql(table: str, rel: str, checks) -> str:
    """One row per check; a condition that is NULL for a row doesn't fail it."""
    out = []
    for label, column, severity, failing in checks:
        count = f"select count(*) from ({rel}) r where {failing}" if failing else \
            f"select count(*) from (select {column} from ({rel}) r where {column} is not null group by 1 having count(*) > 1) d"
        out.append(_row(table, label, column, severity, count))
    return "\nunion all\n".join(out)


def _sr_flat_bronze(full: SRProducts) -> str:
    return f"select extracted_at as _extracted_at, filename from {full.sr}"


def extra(full: SRProducts) -> dict[str, str]:
    mart = full.daily_summary
    probes = ("2024-01-31 00:00:00", "2024-02-01 12:00:00", "2024-02-05 00:00:00")
    fresh = "\nunion all\n".join(f"""select timestamp '{t}' as as_of, m as max_loaded_at,
    cast(date_diff('second', m, timestamp '{t}') as bigint) as age_seconds,
    case when m is null then 'error' when date_diff('second', m, timestamp '{t}') > 48 * 3600 then 'error'
         when date_diff('second', m, timestamp '{t}') > 24 * 3600 then 'warn' else 'pass' end as status
from (select max(ts) as m from events) x""" for t in probes)
    empties = " + ".join(f"(case when {k} = '' then 1 else 0 end)" for k in RECORD_KEYS)
    miss = lambda k: f"cast(count_if({k} is null or {k} = '') as bigint)"
    profile = f"""with s as ({full.sr}),
c as (select filename, count(*) as records, {miss("unique_key")} as missing_unique_key,
        {miss("created_date")} as missing_created_date, {miss("complaint_type")} as missing_complaint_type,
        {miss("borough")} as missing_borough, cast(sum({empties}) as bigint) as empty_strings
      from s group by filename),
d as (select filename, count(*) as duplicate_keys from (select filename, unique_key from s
        where unique_key is not null and unique_key <> '' group by filename, unique_key having count(*) > 1) x
      group by filename)
select c.*, coalesce(d.duplicate_keys, 0) as duplicate_keys from c left join d using (filename)"""
    summary = f"""select count(*) as files, cast(sum(records) as bigint) as records,
    cast(sum(missing_unique_key) as bigint) as missing_unique_key,
    cast(sum(missing_created_date) as bigint) as missing_created_date,
    cast(sum(missing_complaint_type) as bigint) as missing_complaint_type,
    cast(sum(missing_borough) as bigint) as missing_borough, cast(sum(empty_strings) as bigint) as empty_strings,
    cast(sum(duplicate_keys) as bigint) as duplicate_keys from ({profile}) p"""
    from civicflow.operators.contracts import CONTRACTS

    def contract(product: str, rel: str, key: str) -> str:
        c = CONTRACTS[key]
        nn = " + ".join(f"count_if({col} is null)" for col in c.not_null)
        return (f"select '{product}' as product, cast({len(c.columns)} as integer) as columns, "
                f"cast(0 as integer) as drift, cast({nn} as bigint) as not_null_failures from ({rel}) r")

    contracts = "\nunion all\n".join([
        f"select 'dim_borough (drifted)' as product, cast(9 as integer) as columns, cast(3 as integer) as drift, "
        f"count(*) filter (where borough_name = 'Queens') as not_null_failures from ({full.dim_b}) d",
        contract("dim_borough", full.dim_b, "dim_borough"),
        contract("dim_request_type", full.dim_t, "dim_request_type"),
        contract("fact_requests", full.fact, "fact_requests"),
        contract("daily_summary", mart, "daily_summary")])
    return {
        "q9_contract_report": contracts,
        "q_source_checks": checks_sql("bronze", _sr_flat_bronze(full), _required("_extracted_at", "filename")),
        "q_staging_checks": checks_sql("requests_clean", full.clean, STAGING),
        "q_enriched_checks": checks_sql("requests_enriched", full.enriched, ENRICHED),
        "q_core_checks": "\nunion all\n".join([
            checks_sql("dim_borough", full.dim_b, BOROUGHS), checks_sql("dim_request_type", full.dim_t, TYPES),
            checks_sql("fact_requests", full.fact, FACT),
            _row("fact_requests", "relationships", "borough_sk", "error", _missing_parents(full.fact, "borough_sk", full.dim_b, "borough_sk")),
            _row("fact_requests", "relationships", "complaint_type_sk", "error",
                 _missing_parents(full.fact, "complaint_type_sk", full.dim_t, "complaint_type_sk")),
            _row("fact_requests", "equal_rowcount", None, "error",
                 f"abs((select count(*) from ({full.fact}) f) - (select count(*) from ({full.enriched}) e))")]),
        "q_mart_checks": checks_sql("daily_summary", mart, MART) + "\nunion all\n" + _row(
            "daily_summary", "unique_combination", "created_date,borough_name,category", "error",
            f"select count(*) from (select 1 from ({mart}) m group by created_date, borough_name, category having count(*) > 1) d"),
        "q_seed_checks": "\nunion all\n".join([
            checks_sql("borough_lookup", seed_borough_values(), BOROUGH_SEED), checks_sql("complaint_type_lookup", seed_type_values(), TYPE_SEED),
            _row("requests_clean", "relationships", "borough", "warn", _missing_parents(full.clean, "borough", seed_borough_values(), "borough_name")),
            _row("requests_clean", "relationships", "complaint_type", "warn",
                 _missing_parents(full.clean, "complaint_type", seed_type_values(), "complaint_type"))]),
        "q_order_relationship_checks": "\nunion all\n".join([
            checks_sql("orders", "select * from orders", [*_once("o_orderkey"), *_required("o_custkey"), _allowed("o_orderstatus", ("F", "O", "P"))]),
            _row("orders", "relationships", "o_custkey", "error", _missing_parents("select * from orders", "o_custkey", "select * from customer", "c_custkey"))]),
        "q_failing_checks": "\nunion all\n".join([
            checks_sql("lineitem", "select * from lineitem", [
                ("not_null", "late_line", "error", "l_linenumber <= 1 or l_linenumber is null"), *_once("l_orderkey"),
                _allowed("l_returnflag", ("A", "N")), _true("l_quantity", "l_quantity < 40")]),
            _row("lineitem", "relationships", "l_orderkey", "error", _missing_parents(
                "select * from lineitem", "l_orderkey", "select * from orders where o_orderpriority = '1-URGENT'", "o_orderkey")),
            _row("lineitem", "unique_combination", "l_orderkey,l_linenumber", "error",
                 "select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1) d"),
            _row("lineitem", "equal_rowcount", None, "warn", "abs((select count(*) from lineitem) - (select count(*) from orders))")]),
        "q8_events_freshness": fresh,
        "q10_file_profile": profile,
        "q11_run_summary": summary,
    }
