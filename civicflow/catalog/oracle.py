"""Oracle SQL (DuckDB dialect) for the service-request products.

Each product is stated from its definition over the flat fixture: which columns it has
comes from the contracts, accepted lists and buckets come from the fixed values as VALUES
relations, and every rule is written as one expression per column.
"""

from __future__ import annotations

from civicflow.fixed_values import (AGE_BUCKET_ELSE, AGE_BUCKETS, BOROUGH_PLACEHOLDERS, DEFAULT_CATEGORY, INITCAP_DELIMITERS,
                                    OPEN_STATUSES, RECORD_KEYS, RESOLVED_STATUSES, SOURCE_TAG, SURROGATE_NULL_TOKEN, UNKNOWN,
                                    UNKNOWN_BOROUGH_CODE)
from civicflow.operators.contracts import CONTRACTS
from civicflow.plans.enriched import ENRICHED_COLUMNS
from civicflow.plans.staging import BASE_COLUMNS, TIEBREAK_COLUMNS
from civicflow.sources.seeds import seed_rows

AS_OF = "2024-02-03 00:00:00"


def lit(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def values(rows, columns: str) -> str:
    return f"(values {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) {columns}"


def among(column: str, options) -> str:
    return f"{column} in ({', '.join(map(lit, options))})"


def duck_type(spark_type: str) -> str:
    return {"string": "varchar", "timestamp_ntz": "timestamp"}.get(spark_type, spark_type)


def pick(index: str, options) -> str:
    """The option at a zero-based index."""
    return f"([{', '.join(map(lit, options))}])[{index} + 1]"


ISO = "replace(cast({} as varchar), ' ', 'T')"

# The fixture rule (FIXTURES.md, section 3): one expression per record key.
RECORD = {
    "unique_key": "case when e % 101 <> 0 then if(e % 13 = 0, ' ', '') || e end",
    "created_date": f"if(e % 97 = 0, 'not-a-date', {ISO.format('created')})",
    "closed_date": f"case when kind = 'view' and first then '' when kind <> 'error' then "
                   f"{ISO.format('if(e % 89 = 0 and drop_no < {early}, created - interval 5 hour, closed)')} end",
    "resolution_action_updated_date": f"case when e % 7 <> 0 then {ISO.format('created + to_days(cast(drop_no as int))')} end",
    "agency": pick("e % 3", ("NYPD", " DOT ", "")),
    "agency_name": pick("e % 3", ("Police", " Transportation", "")),
    "complaint_type": pick("e % 8", ("HEAT/HOT WATER", "noise - street/sidewalk", " Illegal Parking ", "Rodent", "Water Leak", "",
                                     "Mystery Type", "NOISE")),
    "descriptor": pick("e % 5", ("loud music/party", "POTHOLE", " no access", "", None)),
    "status": "case when kind = 'view' and first then 'OPEN' when kind = 'error' then 'in progress' when kind = 'signup' then ' closed ' "
              "when kind = 'click' and e % 50 = 0 then 'Unspecified' else 'Closed' end",
    "resolution_description": "case when e % 6 <> 1 then if(first, 'Under review', ' Work completed ') end",
    "incident_zip": "'0' || (1000 + u)",
    "incident_address": "u || ' MAIN STREET'",
    "street_name": "if(u % 4 = 0, '', ' MAIN STREET ')",
    "city": pick("u % 3", ("NEW YORK", "brooklyn ", None)),
    "borough": pick("u % 7", ("MANHATTAN", "BROOKLYN", "queens ", "BRONX", "STATEN ISLAND", "Unspecified", " n/a ")),
    "community_board": "lpad(cast(u % 18 as varchar), 2, '0')",
    "council_district": "if(u % 9 = 0, '', cast(u % 51 + 1 as varchar))",
    "latitude": "if(e % 83 = 0, 'x', cast(cast(40 + (e % 1250) / 1000.0 as decimal(18,6)) as varchar))",
    "longitude": "cast(cast(if(e % 11 = 0, 40, -74) + (e % 500) / 1000.0 as decimal(18,6)) as varchar)",
    "open_data_channel_type": pick("e % 3", ("ONLINE", "phone", "")),
}
def records_sql(drops: str = "(1), (2)", early: int = 3) -> str:
    """The fixture's drops; ids divisible by 89 close before their creation in drops below ``early``."""
    record = ", ".join(f"{RECORD[k].replace('{early}', str(early))} as {k}" for k in RECORD_KEYS)
    return f"""select {record},
  'source/2024-02-0' || drop_no || '/batch' || (e - e % 1000) || '.json' as filename,
  timestamp '2024-02-01 05:00:00' + to_days(cast(drop_no as int) - 1) as extracted_at
from (select d as drop_no, d = 1 as first, event_id as e, user_id as u, event_type as kind,
        date_trunc('second', ts) - to_days(cast(31 * (event_id % 3) as int)) as created,
        date_trunc('second', ts) - to_days(cast(31 * (event_id % 3) as int)) + to_minutes(cast(floor(value * 60) as int)) as closed
      from events, (values {drops}) as drops(d)
      where case d when 1 then event_id % 10 <> 9 when 2 then event_id % 10 in (0, 9) else event_id % 89 = 0 end)"""


def title(x: str) -> str:
    """Every maximal run of non-delimiters starts with a capital."""
    token = f"([^{INITCAP_DELIMITERS}]+|[{INITCAP_DELIMITERS}]+)"
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), '{token}', 1), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), '')")


def surrogate(column: str) -> str:
    return f"md5(coalesce(cast({column} as varchar), {lit(SURROGATE_NULL_TOKEN)}))"


def sr_where(cond: str = "true", **fixture) -> str:
    return f"(select * from ({records_sql(**fixture)}) s where {cond})"


_BASE = {
    "complaint_id": "unique_key", "created_at": "try_cast(created_date as timestamp)", "closed_at": "try_cast(closed_date as timestamp)",
    "resolution_updated_at": "try_cast(resolution_action_updated_date as timestamp)", "agency_code": "agency",
    "complaint_descriptor": "descriptor", "latitude": "try_cast(latitude as decimal(18,12))",
    "longitude": "try_cast(longitude as decimal(18,12))", "submission_channel": "open_data_channel_type",
    "source_filename": "filename", "source_relation": lit(SOURCE_TAG),
}


def base_sql(sr: str) -> str:
    """The typed columns of each record."""
    return f"select {', '.join(f'{_BASE.get(c, c)} as {c}' for c in BASE_COLUMNS)} from {sr}"


_TITLED = ("complaint_type", "complaint_descriptor", "status", "submission_channel")
_AS_IS = ("created_at", "closed_at", "resolution_updated_at", "extracted_at", "source_filename", "source_relation")


def _cleaned(column: str, lat, lon) -> str:
    blank = f"nullif(trim({column}), '')"
    if column in _AS_IS:
        return column
    if column == "complaint_id":
        return f"trim({column})"
    if column in ("latitude", "longitude"):
        low, high = lat if column == "latitude" else lon
        return f"if({column} >= {low} and {column} <= {high}, {column}, null)"
    if column == "borough":
        return f"if({among(f'upper(trim({column}))', BOROUGH_PLACEHOLDERS)}, null, {title(f'trim({column})')})"
    return title(blank) if column in _TITLED else blank


def clean_sql(base: str, lat=(40, 41), lon=(40, 41)) -> str:
    """Each id's newest file decides; ids whose newest row has no creation time are out."""
    order = ", ".join(["source_filename desc nulls first", "extracted_at desc nulls last", "created_at desc nulls last",
                       *[f"{c} asc nulls first" for c in TIEBREAK_COLUMNS]])
    tidy = ", ".join(f"{_cleaned(c, lat, lon)} as {c}" for c in BASE_COLUMNS)
    return f"""select * from (select * from (select {tidy} from ({base}) records)
  where complaint_id is not null
  qualify row_number() over (partition by complaint_id order by {order}) = 1) newest
where created_at is not null"""


def _buckets() -> str:
    """Age ranges (from, to, label); the first bucket is its one value, negative ages fall into the second."""
    (zero, first), (week, second), *rest = AGE_BUCKETS
    rows, low = [(-10**6, zero - 1, second), (zero, zero, first), (zero + 1, week, second)], week + 1
    for top, label in rest:
        rows.append((low, top, label))
        low = top + 1
    return values([*rows, (low, 10**6, AGE_BUCKET_ELSE)], "as bucket(youngest, oldest, label)")


def enriched_sql(clean: str, as_of: str = AS_OF) -> str:
    """Derived columns of each request; all others are P2's."""
    age = f"date_diff('day', created_at, timestamp '{as_of}')"
    took = lambda unit: f"cast(if(closed_at >= created_at, date_diff('{unit}', created_at, closed_at), null) as integer)"
    derived = {
        "created_date": "cast(created_at as date)", "created_month": "cast(date_trunc('month', created_at) as date)",
        "created_week": "cast(date_trunc('week', created_at) as date)", "created_year": "cast(extract(year from created_at) as integer)",
        "created_hour": "cast(extract(hour from created_at) as integer)", "created_day_of_week": "strftime(created_at, '%a')",
        "response_time_hours": took("hour"), "response_time_days": took("day"),
        "is_resolved": f"coalesce({among('status', RESOLVED_STATUSES)}, false) and closed_at is not null",
        "is_open": f"coalesce({among('status', OPEN_STATUSES)}, false) or closed_at is null",
        "days_since_created": f"cast({age} as integer)", "complaint_age_bucket": "bucket.label",
        "has_geolocation": "coalesce(latitude, longitude) is not null", "has_borough": "borough is not null",
    }
    columns = ", ".join(f"{derived[c]} as {c}" if c in derived else c for c in ENRICHED_COLUMNS)
    return f"select {columns} from ({clean}) requests join {_buckets()} on {age} between youngest and oldest"


def _typed(product: str, expressions: dict[str, str]) -> str:
    """A product's columns in contract order, cast to the contract's types."""
    return ", ".join(f"cast({expressions.get(c, c)} as {duck_type(t)}) as {c}" for c, t in CONTRACTS[product].declared)


def seed_borough_values() -> str:
    rows = [(r["borough_name"], r["borough_code"], r["county_name"], int(r["population_2020"]), float(r["area_sq_mi"]))
            for r in seed_rows("borough_lookup")]
    return f"""select borough_name, borough_code, county_name, cast(population_2020 as decimal(10,0)) as population_2020,
  cast(area_sq_mi as decimal(6,2)) as area_sq_mi
from {values(rows, "as seed(borough_name, borough_code, county_name, population_2020, area_sq_mi)")}"""


def seed_type_values() -> str:
    rows = [(r["complaint_type"], r["category"], r["is_quality_of_life"].lower() == "true", r["is_emergency"].lower() == "true")
            for r in seed_rows("complaint_type_lookup")]
    return f"select * from {values(rows, 'as seed(complaint_type, category, is_quality_of_life, is_emergency)')}"


def _observed(clean: str, column: str) -> str:
    """Values of a column that occur, and the sentinel."""
    return f"select {column} as name from ({clean}) requests where {column} is not null union select {lit(UNKNOWN)}"


def dim_borough_sql(clean: str, as_of: str = AS_OF) -> str:
    """The sentinel counts as known, so it joins like a seed row without figures."""
    return f"""select {_typed("dim_borough", {
        "borough_sk": surrogate("name"), "borough_name": "name", "area_sq_mi": "area_sq_mi",
        "population_density_per_sq_mi": "if(area_sq_mi > 0, round(population_2020 / area_sq_mi, 0), null)",
        "is_missing_metadata": "known is null", "dim_loaded_at": f"timestamp '{as_of}'"})}
from ({_observed(clean, "borough")}) seen left join (
  select true as known, * from ({seed_borough_values()}) seed
  union all select true, {lit(UNKNOWN)}, {lit(UNKNOWN_BOROUGH_CODE)}, {lit(UNKNOWN)}, null, null) meta on name = borough_name"""


def dim_type_sql(clean: str, as_of: str = AS_OF) -> str:
    """P5: types without metadata get the defaults."""
    return f"""select {_typed("dim_request_type", {
        "complaint_type_sk": surrogate("name"), "complaint_type": "name", "category": f"coalesce(category, {lit(DEFAULT_CATEGORY)})",
        "is_quality_of_life": "coalesce(is_quality_of_life, false)", "is_emergency": "coalesce(is_emergency, false)",
        "is_missing_metadata": f"complaint_type is null and name <> {lit(UNKNOWN)}", "dim_loaded_at": f"timestamp '{as_of}'"})}
from ({_observed(clean, "complaint_type")}) seen left join ({seed_type_values()}) seed on name = complaint_type"""


def fact_rows_sql(enriched: str, dim_b: str, dim_t: str, as_of: str = AS_OF, where: str = "true") -> str:
    """Each request with the keys of its dimension rows, or the sentinel's."""
    key = lambda dim, sk, name, wanted: (f"coalesce((select {sk} from {dim} d where d.{name} = r.{wanted}), "  # noqa: E731
                                         f"(select {sk} from {dim} d where d.{name} = {lit(UNKNOWN)}))")
    expressions = {c: f"r.{c}" for c, _ in CONTRACTS["fact_requests"].declared} | {
        "complaint_sk": surrogate("r.complaint_id"), "borough_sk": key("boroughs", "borough_sk", "borough_name", "borough"),
        "complaint_type_sk": key("types", "complaint_type_sk", "complaint_type", "complaint_type"), "fct_loaded_at": f"timestamp '{as_of}'"}
    return f"""with boroughs as ({dim_b}), types as ({dim_t})
select {_typed("fact_requests", expressions)} from (select * from ({enriched}) x where {where}) r"""


def daily_summary_sql(fact: str, dim_b: str, dim_t: str, as_of: str = AS_OF) -> str:
    """Counts are filters of one count; the rate is rounded half up in whole tenths."""
    n = "count(*)"
    having = lambda flag: f"{n} filter (where {flag})"
    hours = "response_time_hours"
    return f"""select {_typed("daily_summary", {
        "total_complaints": n, "resolved_complaints": having("is_resolved"), "open_complaints": having("is_open"),
        "quality_of_life_complaints": having("is_quality_of_life"), "emergency_complaints": having("is_emergency"),
        "pct_resolved": f"cast((2000 * {having('is_resolved')} + {n}) // (2 * {n}) as decimal(18,1)) * 0.1",
        "median_response_hours": f"round(quantile_cont({hours}, 0.5), 1)", "p90_response_hours": f"round(quantile_cont({hours}, 0.9), 1)",
        "max_response_hours": f"max({hours})", "report_loaded_at": f"timestamp '{as_of}'"})}
from ({fact}) facts join ({dim_b}) boroughs using (borough_sk) join ({dim_t}) types using (complaint_type_sk)
group by created_date, borough_name, category"""


class SRProducts:
    """Oracle SQL text of every SR product for one bronze selection."""

    def __init__(self, sr_filter: str = "true", as_of: str = AS_OF, **fixture):
        self.as_of, self.sr = as_of, sr_where(sr_filter, **fixture)
        self.base = base_sql(self.sr)
        self.clean = clean_sql(self.base)
        self.enriched = enriched_sql(self.clean, as_of)
        self.dim_b, self.dim_t = dim_borough_sql(self.clean, as_of), dim_type_sql(self.clean, as_of)

    def fact_rows(self, where: str = "true") -> str:
        return fact_rows_sql(self.enriched, self.dim_b, self.dim_t, self.as_of, where)

    @property
    def fact(self) -> str:
        return self.fact_rows()

    @property
    def daily_summary(self) -> str:
        return daily_summary_sql(self.fact, self.dim_b, self.dim_t, self.as_of)


def oracle_sql() -> dict[str, str]:
    from civicflow.catalog import oracle_checks, oracle_extra

    full = SRProducts()
    return {
        "p1_base": full.base,
        "p2_requests_clean": full.clean,
        "p3_requests_enriched": full.enriched,
        "p4_dim_borough": full.dim_b,
        "p5_dim_request_type": full.dim_t,
        "p6_fact_requests": full.fact,
        "p7_daily_summary": full.daily_summary,
        **oracle_extra.extra(full), **oracle_extra.io_extra(full), **oracle_checks.extra(full),
    }
