"""Plan regression tests: the physical properties the design relies on at scale."""

import __spark_entry__ as E
from civicflow.catalog import queries

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_uses_broadcast_lookups_and_pruned_silver_scan(spark):
    df = E.queries()["p7_daily_summary"](spark, SF)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "created_at#" in ln]
    assert scans
    for ln in scans:  # silver has 23 columns; only the 5 the mart needs are read
        cols = ln.split("FileScan parquet [", 1)[1].split("]", 1)[0].split(",")
        assert len(cols) <= 6, ln


def test_clean_dedup_limits_before_shuffle(spark):
    df = E.queries()["p2_requests_clean"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # AQE final plan: the partial group limit sits below the exchange.
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_high_water_mark_reaches_the_scan(spark):
    df = E.queries()["i1_orders_since_mark"](spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate,ScalarSubquery" in plan


def test_no_registered_query_plans_a_cross_join(spark):
    offenders = []
    for name, fn in sorted(queries().items()):
        plan = _plan(fn(spark, SF))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            offenders.append(name)
    assert offenders == []
