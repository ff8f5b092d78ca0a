"""Stand-alone operator queries on the driver tables and the SR fixture.

Each exercises one operator family of the inventory over whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from civicflow.functions import day_diff, hour_diff, surrogate_key, title_case
from civicflow.operators.dedup import latest_per_key
from civicflow.operators.history import as_of, snapshot_check
from civicflow.operators.incremental import evolve_union, merge_upsert, since
from civicflow.operators.lookup import orphans, star_join
from civicflow.operators.ranking import exact_percentiles
from civicflow.plans.history import request_history
from civicflow.plans.build import GoldBuild
from civicflow.sources.paging import PageIndex, page, paged
from civicflow.sources.service_requests import AS_OF

ORDERS_CUT = "1998-01-01 00:00:00"
HISTORY_RUN_1 = "2024-03-01 00:00:00"
HISTORY_RUN_2 = "2024-03-02 00:00:00"
HISTORY_PROBE = "2024-03-01 12:00:00"


def _t(spark, sf_dir, name):
    from civicflow.catalog.queries import table
    return table(spark, sf_dir, name)


def _prep(spark):
    from civicflow.catalog.queries import _prepare
    _prepare(spark)


# --- windows -------------------------------------------------------------------

def q_latest_lineitem(spark, sf_dir):
    """One line per (l_orderkey, l_linenumber): latest ship date (NULLs first), full tie-break."""
    li = _t(spark, sf_dir, "lineitem")
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_first()],
                          [F.col(c).asc() for c in rest])


def q_latest_event_per_user(spark, sf_dir):
    """Latest event per user, ``ts DESC NULLS LAST``, ties by event_id."""
    ev = _t(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id"], [F.col("ts").desc_nulls_last()], [F.col("event_id").desc()]) \
        .select("user_id", "event_id", "ts", "event_type")


# --- joins ---------------------------------------------------------------------

def q_order_orphans(spark, sf_dir):
    """Orders whose customer is not among those in credit (left anti join)."""
    return orphans(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer").where("c_acctbal >= 0"), "o_custkey", "c_custkey") \
        .select("o_orderkey", "o_custkey")


def q_customers_without_orders(spark, sf_dir):
    """J8 reversed: customers without a recent urgent order."""
    recent = _t(spark, sf_dir, "orders").where((F.col("o_orderdate") >= F.lit(ORDERS_CUT).cast("timestamp_ntz"))
                                               & (F.col("o_orderpriority") == "1-URGENT"))
    return orphans(_t(spark, sf_dir, "customer"), recent, "c_custkey", "o_custkey") \
        .select("c_custkey", "c_name")


def q_orders_by_region(spark, sf_dir):
    """Inner star join orders -> customer -> nation -> region, then grouped.

    No hints: small sides are broadcast from measured sizes, a large customer table is
    joined by shuffle.
    """
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = _t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nr = star_join(n, [(r, "n_regionkey")])
    j = o.join(c, "o_custkey").join(nr, "c_nationkey")
    return j.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total_price"))


def q_order_ship_durations(spark, sf_dir):
    """Hours and days from order to ship, NULL when shipped before ordered."""
    o = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    j = li.join(o, "l_orderkey")
    ok = F.col("l_shipdate").isNotNull() & (F.col("l_shipdate") >= F.col("o_orderdate"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey",
                    F.when(ok, hour_diff("o_orderdate", "l_shipdate")).alias("hours_to_ship"),
                    F.when(ok, day_diff("o_orderdate", "l_shipdate")).alias("days_to_ship"))


# --- aggregates ------------------------------------------------------------------

def q_quantity_percentiles(spark, sf_dir):
    """A4: exact p50/p90 of quantity per return flag (linear interpolation)."""
    li = _t(spark, sf_dir, "lineitem")
    p = F.percentile("l_quantity", F.array(F.lit(0.5), F.lit(0.9)))
    return li.groupBy("l_returnflag").agg(p.alias("p"), F.max("l_quantity").alias("max_quantity"),
                                          F.count(F.lit(1)).alias("lines")) \
        .select("l_returnflag", F.col("p")[0].alias("p50_quantity"), F.col("p")[1].alias("p90_quantity"),
                "max_quantity", "lines")


def q_event_value_percentiles(spark, sf_dir):
    """A4 on events: exact p50/p90 of value per event type (rounded to 6 places)."""
    _prep(spark)
    found = exact_percentiles(_t(spark, sf_dir, "events"), "event_type", "value", {"p50_value": 0.5, "p90_value": 0.9})
    return found.select("event_type", F.round("p50_value", 6).alias("p50_value"), F.round("p90_value", 6).alias("p90_value"))


def q_duplicate_line_keys(spark, sf_dir):
    """``group by key having count(*) > 1``."""
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")) \
        .filter(F.col("copies") > 1)


# --- scalar functions ------------------------------------------------------------------

def q_title_case_parts(spark, sf_dir):
    """Warehouse-style title case over whole part names and types."""
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", title_case(F.upper("p_name")).alias("name_title"),
                    title_case(F.concat_ws("/", "p_type", "p_brand")).alias("type_title"))


def q_order_keys(spark, sf_dir):
    """Hashed surrogate keys over two columns, one of them NULL for some rows."""
    o = _t(spark, sf_dir, "orders")
    cust = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey"))
    return o.select("o_orderkey", surrogate_key("o_orderkey").alias("order_sk"),
                    surrogate_key(F.col("o_orderkey"), cust).alias("order_customer_sk"))


# --- paging --------------------------------------------------------------------------

def q_events_page(spark, sf_dir):
    """The second page (offset 1000, 1000 rows) of events, newest first."""
    return page(_t(spark, sf_dir, "events"), "ts", "event_id", limit=1000, offset=1000) \
        .select("event_id", "ts", "event_type")


def q_events_paged(spark, sf_dir):
    """All pages, newest first, numbered with their batch offset."""
    _prep(spark)
    return paged(_t(spark, sf_dir, "events"), "ts", "event_id").select("event_id", "rank", "batch_offset")


# --- incremental ------------------------------------------------------------------------

def _orders_batches(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    cut = F.lit(ORDERS_CUT).cast("timestamp_ntz")
    target = o.filter(F.col("o_orderdate") < cut)
    resent = o.filter((F.col("o_orderdate") < cut) & (F.col("o_orderkey") % 7 == 0)) \
        .withColumn("o_orderstatus", F.lit("R"))
    src = o.filter(F.col("o_orderdate") >= cut).unionByName(resent)
    return target, src


def q_events_deep_page(spark, sf_dir):
    """The page that begins after nine tenths of all events, read by a seek."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return PageIndex(ev, "ts", "event_id").page(offset=ev.count() * 9 // 10)


def q_orders_since_mark(spark, sf_dir):
    """Rows newer than the target's high-water mark (scalar subquery)."""
    o = _t(spark, sf_dir, "orders")
    target = o.filter(F.col("o_orderdate") < F.lit(ORDERS_CUT).cast("timestamp_ntz"))
    return since(o, target, "o_orderdate").select("o_orderkey", "o_orderdate")


def q_orders_merge(spark, sf_dir):
    """Keyed upsert of a batch with re-sent, changed orders."""
    target, src = _orders_batches(spark, sf_dir)
    return merge_upsert(target, src, ["o_orderkey"])


def q_orders_evolve(spark, sf_dir):
    """The second batch carries a new column; old rows get NULL for it."""
    target, src = _orders_batches(spark, sf_dir)
    src = src.withColumn("o_note", F.concat(F.lit("n"), F.col("o_orderkey").cast("string"))).drop("o_orderpriority")
    return evolve_union(target.join(src.select("o_orderkey"), "o_orderkey", "left_anti"), src)


def _customer_generations(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    gen1 = c
    changed = F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    kept = c.filter(F.col("c_custkey") % 17 != 0).withColumn("c_acctbal", changed)
    added = c.filter(F.col("c_custkey") % 50 == 0).withColumn("c_custkey", F.col("c_custkey") + 1_000_000)
    return gen1, kept.unionByName(added)


def q_customer_history(spark, sf_dir):
    """I4: two check-strategy snapshot runs over customer generations."""
    g1, g2 = _customer_generations(spark, sf_dir)
    cols = ("c_name", "c_acctbal", "c_mktsegment")
    h1 = snapshot_check(None, g1, "c_custkey", cols, HISTORY_RUN_1)
    return snapshot_check(h1, g2, "c_custkey", cols, HISTORY_RUN_2)


def q_customer_as_of(spark, sf_dir):
    """Versions current at a point between the two runs."""
    return as_of(q_customer_history(spark, sf_dir), HISTORY_PROBE)


def q_request_history(spark, sf_dir):
    """Request history after drop 1 and after drop 2."""
    from civicflow.catalog.queries import sr_bronze
    from civicflow.sources.service_requests import DROP_LOADED_AT
    _prep(spark)
    bronze = sr_bronze(spark, sf_dir)  # derived once: the first run sees what drop 1 loaded of it
    h1 = request_history(None, bronze.where(F.col("_extracted_at") == F.lit(DROP_LOADED_AT[1]).cast("timestamp_ntz")), HISTORY_RUN_1)
    return request_history(h1, bronze, HISTORY_RUN_2)


def q_fact_incremental(spark, sf_dir):
    """I1 + I2 on the fact: run 1 over drop 1, run 2 over both drops merged in."""
    from civicflow.catalog.queries import sr_bronze
    _prep(spark)
    run1 = GoldBuild(spark, sr_bronze(spark, sf_dir, (1,)), AS_OF).fact
    from civicflow.plans.build import materialize
    run1 = materialize(run1, "fact_run1")
    return GoldBuild(spark, sr_bronze(spark, sf_dir, (1, 2)), AS_OF, target_fact=run1).fact


def extra() -> dict:
    from civicflow.catalog import queries_checks, queries_io
    out = {
        "w1_latest_lineitem": q_latest_lineitem,
        "w2_latest_event_per_user": q_latest_event_per_user,
        "j8_order_orphans": q_order_orphans,
        "j8_customers_without_orders": q_customers_without_orders,
        "j5_orders_by_region": q_orders_by_region,
        "x14_order_ship_durations": q_order_ship_durations,
        "a4_quantity_percentiles": q_quantity_percentiles,
        "a4_event_value_percentiles": q_event_value_percentiles,
        "a11_duplicate_line_keys": q_duplicate_line_keys,
        "x6_title_case_parts": q_title_case_parts,
        "x19_order_keys": q_order_keys,
        "s6_events_page": q_events_page,
        "s6_events_paged": q_events_paged,
        "s6_events_deep_page": q_events_deep_page,
        "i1_orders_since_mark": q_orders_since_mark,
        "i2_orders_merge": q_orders_merge,
        "i3_orders_evolve": q_orders_evolve,
        "i4_customer_history": q_customer_history,
        "i7_customer_as_of": q_customer_as_of,
        "p8_request_history": q_request_history,
        "i2_fact_incremental": q_fact_incremental,
    }
    out.update(queries_checks.extra())
    out.update(queries_io.extra())
    return out
