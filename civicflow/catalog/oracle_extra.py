"""Oracle SQL for the BI questions and the stand-alone operator queries."""

from __future__ import annotations


from civicflow.catalog.oracle import SRProducts, lit, surrogate, title
from civicflow.fixed_values import SURROGATE_NULL_TOKEN

CUT = "timestamp '1998-01-01 00:00:00'"
RUN1, RUN2, PROBE = "timestamp '2024-03-01 00:00:00'", "timestamp '2024-03-02 00:00:00'", "timestamp '2024-03-01 12:00:00'"


def _snapshot(key: str, cols: list[str], src1: str, src2: str, run1: str = RUN1, run2: str = RUN2) -> str:
    """Versions of two snapshot runs by their change points: one starts where a key's tracked columns differ from its row
    before, and ends where its next one starts."""
    tracked = f"row({', '.join(cols)})"
    return f"""select {key}, {", ".join(cols)}, md5(coalesce(cast({key} as varchar), '') || '|' || cast(run_at as varchar)) as scd_id, run_at as updated_at,
  run_at as valid_from, lead(run_at) over (partition by {key} order by run_at) as valid_to
from (select *, {tracked} as this, lag({tracked}) over (partition by {key} order by run_at) as before, row_number() over (partition by {key} order by run_at) = 1 as first
      from (select {run1} as run_at, {key}, {", ".join(cols)} from ({src1}) a union all select {run2}, {key}, {", ".join(cols)} from ({src2}) b) runs) seen
where first or this is distinct from before"""


def _history_input(sr: str) -> str:
    return f"""select complaint_id, status, closed_at, resolution_description, resolution_updated_at, agency_code
from (select unique_key as complaint_id, status, try_cast(closed_date as timestamp) as closed_at,
        resolution_description, try_cast(resolution_action_updated_date as timestamp) as resolution_updated_at,
        agency as agency_code, filename, extracted_at from {sr} s where unique_key is not null) x
qualify row_number() over (partition by complaint_id order by filename desc nulls last, extracted_at desc nulls last, status nulls first,
          closed_at nulls first, resolution_description nulls first, resolution_updated_at nulls first, agency_code nulls first) = 1"""


def _tenths(part: str, whole: str) -> str:
    """100 * part / whole, rounded half up to one decimal in whole numbers."""
    return f"cast((2000 * cast({part} as bigint) + cast({whole} as bigint)) // (2 * cast({whole} as bigint)) as decimal(18,1)) * 0.1"


def _questions(full) -> dict[str, str]:
    """P9-P11 and the SQL questions, over the gold products."""
    fact, boroughs, types, daily = (f"({x}) {n}" for x, n in ((full.fact, "facts"), (full.dim_b, "boroughs"), (full.dim_t, "types"),
                                                              (full.daily_summary, "daily")))
    people = "cast(any_value(population_2020) as bigint)"
    per_capita = f"""select borough_name, any_value(population_2020) as population_2020, count(complaint_sk) as total_complaints,
  cast(cast((2 * count(complaint_sk) * 10000000 + {people}) // (2 * {people}) as decimal(18,0)) * 0.01 as decimal(18,2)) as complaints_per_100k
from {boroughs} join {fact} using (borough_sk) group by borough_name having any_value(population_2020) is not null"""
    median = f"""select category, count(complaint_sk) as complaints, quantile_cont(cast(response_time_hours as double), 0.5) as median_hours
from {types} join (select * from {fact} where is_resolved) resolved using (complaint_type_sk) group by category"""
    trend = f"""select month, cast(total as decimal(28,0)) as complaints, cast({_tenths("resolved", "total")} as decimal(10,1)) as pct_resolved
from (select make_date(cast(year(created_date) as bigint), cast(month(created_date) as bigint), 1) as month,
        sum(total_complaints) as total, sum(resolved_complaints) as resolved from {daily} group by all) months"""
    return {
        "p9_requests_per_100k": per_capita, "p10_median_response_by_category": median, "p11_monthly_trend": trend,
        "s8_sql_per_capita": f"""with rates as ({per_capita})
select a.borough_name, a.complaints_per_100k, cast(1 + count(b.borough_name) as integer) as place,
  a.complaints_per_100k * cast((select sum(population_2020) from rates) as decimal(18,0)) > 100000 * cast((select sum(total_complaints) from rates) as decimal(18,0)) as above_city
from rates a left join rates b on b.complaints_per_100k > a.complaints_per_100k group by all""",
        "s8_sql_median_by_category": f"""with medians as ({median})
select category, median_hours, count(*) as request_types, median_hours > (select avg(median_hours) from medians) as slower_than_most
from medians join {types} using (category) group by category, median_hours""",
        "s8_sql_monthly_trend": f"""with months as ({trend})
select a.month, a.complaints, cast(a.complaints - b.complaints as decimal(29,0)) as change,
  cast(a.pct_resolved - (select pct_resolved from months where month = (select min(month) from months)) as decimal(11,1)) as points_since_start
from months a left join months b on b.month = a.month - interval 1 month""",
        "s8_sql_open_backlog": f"""select borough_name, complaint_age_bucket as age, count(*) as waiting, max(days_since_created) as oldest_days
from {fact}, {boroughs} where facts.borough_sk = boroughs.borough_sk and is_open and not is_missing_metadata
group by borough_name, complaint_age_bucket""",
        "s8_sql_busiest_day": f"""select borough_name, arg_max(created_date, (n, -epoch(created_date))) as created_date,
  cast(max(n) as decimal(28,0)) as requests
from (select borough_name, created_date, sum(total_complaints) as n from {daily} group by all) days group by borough_name""",
    }


def extra(full) -> dict[str, str]:
    bi = _questions(full)
    drop1 = SRProducts("extracted_at = timestamp '2024-02-01 05:00:00'")
    orders_target = f"select * from orders where o_orderdate < {CUT}"
    orders_src = f"""select * from orders where o_orderdate >= {CUT}
        union all select o_orderkey, o_custkey, 'R', o_totalprice, o_orderdate, o_orderpriority
        from orders where o_orderdate < {CUT} and o_orderkey % 7 = 0"""
    cust2 = """select c_custkey, c_name, case when c_custkey % 10 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal,
        c_mktsegment from customer where c_custkey % 17 <> 0
        union all select c_custkey + 1000000, c_name, c_acctbal, c_mktsegment from customer where c_custkey % 50 = 0"""
    cust_hist = _snapshot("c_custkey", ["c_name", "c_acctbal", "c_mktsegment"],
                          "select c_custkey, c_name, c_acctbal, c_mktsegment from customer", cust2)
    return {
        **bi,
        "w1_latest_lineitem": """select * exclude (rn) from (select *, row_number() over (
    partition by l_orderkey, l_linenumber order by l_shipdate desc nulls first, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) as rn from lineitem) x where rn = 1""",
        "w2_latest_event_per_user": """select user_id, event_id, ts, event_type from (select *, row_number() over (
    partition by user_id order by ts desc nulls last, event_id desc) as rn from events) x where rn = 1""",
        "j8_order_orphans": """select o_orderkey, o_custkey from orders where o_custkey is not null
    and o_custkey not in (select c_custkey from customer where c_acctbal >= 0)""",
        "j8_customers_without_orders": f"""select c_custkey, c_name from customer
    where c_custkey not in (select o_custkey from orders where o_orderdate >= {CUT}
      and o_orderpriority = '1-URGENT' and o_custkey is not null)""",
        "j5_orders_by_region": """select r.r_name, n.n_name, count(*) as orders,
    cast(sum(cast(o.o_totalprice as decimal(18,2))) as decimal(28,2)) as total_price
from orders o join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey
     join region r on n.n_regionkey = r.r_regionkey group by r.r_name, n.n_name""",
        "x14_order_ship_durations": """select l.l_orderkey, l.l_linenumber, l.l_partkey,
    case when l.l_shipdate is not null and l.l_shipdate >= o.o_orderdate
         then cast(date_diff('hour', o.o_orderdate, l.l_shipdate) as integer) end as hours_to_ship,
    case when l.l_shipdate is not null and l.l_shipdate >= o.o_orderdate
         then cast(date_diff('day', o.o_orderdate, l.l_shipdate) as integer) end as days_to_ship
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
        "a4_quantity_percentiles": """select l_returnflag, quantile_cont(l_quantity, 0.5) as p50_quantity,
    quantile_cont(l_quantity, 0.9) as p90_quantity, max(l_quantity) as max_quantity, count(*) as lines
from lineitem group by l_returnflag""",
        "a4_event_value_percentiles": """select event_type, round(quantile_cont(value, 0.5), 6) as p50_value,
    round(quantile_cont(value, 0.9), 6) as p90_value from events group by event_type""",
        "a11_duplicate_line_keys": """select l_orderkey, l_linenumber, count(*) as copies from lineitem
group by l_orderkey, l_linenumber having count(*) > 1""",
        "x6_title_case_parts": f"""select p_partkey, {title("upper(p_name)")} as name_title,
    {title("concat_ws('/', p_type, p_brand)")} as type_title from part""",
        "x19_order_keys": f"""select o_orderkey,
    {surrogate("o_orderkey")} as order_sk,
    md5(cast(o_orderkey as varchar) || '-' || if(o_custkey % 5 = 0, {lit(SURROGATE_NULL_TOKEN)}, cast(o_custkey as varchar)))
        as order_customer_sk
from orders""",
        "s6_events_page": """select event_id, ts, event_type from events order by ts desc, event_id
limit 1000 offset 1000""",
        "s6_events_deep_page": """select event_id, ts, event_type from events order by ts desc, event_id
limit 1000 offset (select count(*) * 9 // 10 from events)""",
        "s6_events_paged": """select event_id, rank, cast((rank - 1) // 1000 * 1000 as bigint) as batch_offset
from (select event_id, row_number() over (order by ts desc, event_id) as rank from events) x""",
        "i1_orders_since_mark": f"""select o_orderkey, o_orderdate from orders where o_orderdate >
    (select coalesce(max(o_orderdate), timestamp '1900-01-01') from orders where o_orderdate < {CUT})""",
        "i2_orders_merge": f"""with t as ({orders_target}), s as ({orders_src})
select * from t where o_orderkey not in (select o_orderkey from s) union all select * from s""",
        "i3_orders_evolve": f"""with t as ({orders_target}), s as ({orders_src})
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       cast(null as varchar) as o_note from t where o_orderkey not in (select o_orderkey from s)
union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cast(null as varchar),
       'n' || cast(o_orderkey as varchar) from s""",
        "i4_customer_history": cust_hist,
        "i7_customer_as_of": f"""select * from ({cust_hist}) h where valid_from <= {PROBE}
    and (valid_to is null or valid_to > {PROBE})""",
        "p8_request_history": _snapshot(
            "complaint_id", ["status", "closed_at", "resolution_description", "resolution_updated_at", "agency_code"],
            _history_input(drop1.sr), _history_input(full.sr)),
        "i2_fact_incremental": f"""with f1 as ({drop1.fact}),
inc as ({full.fact_rows("extracted_at > (select coalesce(max(extracted_at), timestamp '1900-01-01') from (" + drop1.fact + ") z)")})
select * from f1 where complaint_id not in (select complaint_id from inc) union all select * from inc""",
    }


HIST_COLS = ["status", "closed_at", "resolution_description", "resolution_updated_at", "agency_code"]


def io_extra(full) -> dict[str, str]:
    drop1 = SRProducts("extracted_at = timestamp '2024-02-01 05:00:00'")
    repaired = SRProducts(early=0)
    corrected = SRProducts(drops="(1), (2), (3)")
    first_seen = "timestamp '2024-02-03 05:00:00'"
    stored_hist = _snapshot("complaint_id", HIST_COLS, _history_input(drop1.sr), _history_input(full.sr),
                            "timestamp '2024-02-01 05:00:00'", "timestamp '2024-02-02 05:00:00'")
    parsed = f"""select unique_key as complaint_id, try_cast(created_date as timestamp) as created_at,
  try_cast(closed_date as timestamp) as closed_at, agency as agency_code, complaint_type, status, incident_zip,
  borough, try_cast(latitude as decimal(18,12)) as latitude, try_cast(longitude as decimal(18,12)) as longitude,
  open_data_channel_type as submission_channel, extracted_at, substr(filename, 8, 10) as landing_day
from {full.sr}"""
    return {
        "s1_landing_arrays": parsed,
        "s1_landing_split_arrays": parsed,
        "s5_landing_lines": parsed,
        "t1_stream_bronze": parsed,
        "s11_landing_inventory": f"""select substr(filename, 8, 10) as landing_date, count(distinct filename) as files
from {full.sr} group by 1""",
        "s1_landing_rejects": """select if(page % 3000 = 0, 'deep', 'flat') as folder, count(*) as rejected
from (select distinct drop_no, event_id - event_id % 1000 as page from events, (values (1), (2)) as drops(drop_no)
      where if(drop_no = 1, event_id % 10 <> 9, event_id % 10 in (0, 9))) pages where page % 4000 = 0 group by 1""",
        "t1_stream_two_checkpoints": f"""select unique_key as complaint_id, 2 * count(*) as loads, max(status) as status
from {full.sr} group by unique_key""",
        "t2_stream_fact": full.fact,
        "t4_stream_history": stored_hist,
        "p12_gated_run": repaired.daily_summary,
        "q12_severities": "select * from (values ('error', false), ('warn', true)) as t(severity, failing)",
        "s10_custom_layers": repaired.dim_t,
        "p12_full_run": full.daily_summary,
        "p12_full_run_history": stored_hist,
        "p12_stopped_run": f"select *, 2 as stops from ({corrected.fact}) f",
        "p12_stopped_run_mart": corrected.daily_summary,
        "p12_stopped_run_history": f"""select complaint_id, {", ".join(HIST_COLS)}, md5(complaint_id || '|' || cast({first_seen} as varchar)) as scd_id,
  {first_seen} as updated_at, {first_seen} as valid_from, cast(null as timestamp) as valid_to from ({_history_input(corrected.sr)}) x""",
        "i6_history_full_refresh": stored_hist,
        "i6_fact_full_refresh": full.fact,
        "i7_request_history_as_of": f"""select * from ({_snapshot("complaint_id", HIST_COLS, _history_input(drop1.sr),
            _history_input(full.sr))}) h where valid_from <= {PROBE} and (valid_to is null or valid_to > {PROBE})""",
    }
