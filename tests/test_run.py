"""Whole-run behaviour: layer gating and incremental == full refresh."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from civicflow.catalog.queries import sr_bronze
from civicflow.catalog.queries_io import DAYS, land_arrays
from civicflow.operators.contracts import CONTRACTS
from civicflow.operators.dedup import latest_per_key
from civicflow.operators.quality import CheckFailed
from civicflow.plans.build import GoldBuild
from civicflow.plans.history import history_input, newer_than_seen, request_history, snapshot_requests
from civicflow.plans.marts import daily_summary
from civicflow.plans.run import Warehouse, build_silver, refresh_dim, refresh_mart, refresh_observed, run_all, since_mark
from civicflow.plans.staging import base, clean
from civicflow.session import scratch_path
from civicflow.sources.service_requests import AS_OF

SF = "/root/testdata/sf0.001"


def _rows(df, drop=()):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_default_run_stops_at_failing_error_check(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    sr_bronze(spark, SF).write.parquet(wh.bronze_dir + "/load=1")
    with pytest.raises(CheckFailed):
        run_all(wh, AS_OF)
    assert wh.silver_latest_table().read() is not None
    assert wh.fact_table().read() is None  # downstream layers not built


def test_incremental_runs_equal_full_refresh(spark):
    inc1 = GoldBuild(spark, sr_bronze(spark, SF, (1,)), AS_OF).fact
    inc2 = GoldBuild(spark, sr_bronze(spark, SF, (1, 2)), AS_OF, target_fact=inc1).fact
    full = GoldBuild(spark, sr_bronze(spark, SF, (1, 2)), AS_OF).fact
    assert _rows(inc2) == _rows(full)
    rerun = GoldBuild(spark, sr_bronze(spark, SF, (1, 2)), AS_OF, target_fact=inc2).fact
    assert _rows(rerun) == _rows(inc2)  # rerunning the merge changes nothing


def test_landing_fixture_pages_are_bounded(spark):
    root = scratch_path(spark, "land")
    land_arrays(spark, SF, root, drops=(1,))
    from pyspark.sql import functions as F
    sizes = spark.read.option("multiLine", "true").option("singleVariantColumn", "raw") \
        .json(f"{root}/{DAYS[1]}").select(F.size(F.col("raw").cast("array<variant>")).alias("n")).collect()
    assert sizes and max(r.n for r in sizes) <= 1000


def test_incremental_silver_equals_full_recompute(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh_silver"))
    b1, b2 = sr_bronze(spark, SF, (1,)), sr_bronze(spark, SF, (2,))
    b1.write.parquet(wh.bronze_dir + "/load=1")
    build_silver(wh, since_mark(wh.bronze(), wh.silver_latest_table().mark()))
    b2.write.parquet(wh.bronze_dir + "/load=2")
    inc = build_silver(wh, since_mark(wh.bronze(), wh.silver_latest_table().mark()))
    full = clean(base(b1.unionByName(b2)))
    assert _rows(inc) == _rows(full.select(*inc.columns))
    # A late file with an *older* name must not displace the newer version.
    late = b1.filter(F.col("filename").contains("batch0.json")).withColumn(
        "_extracted_at", F.lit("2024-02-02 06:00:00").cast("timestamp_ntz"))
    late.write.parquet(wh.bronze_dir + "/load=3")
    after_late = build_silver(wh, since_mark(wh.bronze(), wh.silver_latest_table().mark()))
    full_late = clean(base(b1.unionByName(b2).unionByName(late)))
    assert _rows(after_late) == _rows(full_late.select(*inc.columns))


def test_two_runs_equal_a_full_build_and_a_third_changes_nothing(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh_runs"))
    sr_bronze(spark, SF, (1,)).write.parquet(wh.bronze_dir + "/load=1")
    run_all(wh, AS_OF, on_error="continue")
    sr_bronze(spark, SF, (2,)).write.parquet(wh.bronze_dir + "/load=2")
    out = run_all(wh, AS_OF, on_error="continue", history_at="2024-02-04 00:00:00")
    full = GoldBuild(spark, sr_bronze(spark, SF, (1, 2)), AS_OF)
    columns = CONTRACTS["fact_requests"].columns
    fact = _rows(wh.fact_table().read().select(*columns))
    assert fact == _rows(full.fact.select(*columns))
    mart = daily_summary(full.fact, full.dim_b, full.dim_t, AS_OF)
    assert _rows(out["daily_summary"].select(*mart.columns)) == _rows(mart)
    assert out["freshness"].first().status in ("pass", "warn", "error")
    history = _rows(out["history"])
    again = run_all(wh, AS_OF, on_error="continue", history_at="2024-02-05 00:00:00")
    assert _rows(wh.fact_table().read().select(*columns)) == fact
    assert _rows(again["daily_summary"].select(*mart.columns)) == _rows(mart)
    assert _rows(again["history"]) == history


def test_mart_refresh_rewrites_only_touched_months(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh_mart"))
    D = dt.date
    dim_b = spark.createDataFrame([("b1", "Manhattan", dt.datetime(2024, 1, 1))],
                                  "borough_sk string, borough_name string, dim_loaded_at timestamp_ntz")
    dim_t = spark.createDataFrame([("t1", "Noise", True, False, dt.datetime(2024, 1, 1))],
                                  "complaint_type_sk string, category string, is_quality_of_life boolean, "
                                  "is_emergency boolean, dim_loaded_at timestamp_ntz")
    schema = ("created_date date, created_month date, borough_sk string, complaint_type_sk string, "
              "is_resolved boolean, is_open boolean, response_time_hours int")
    v1 = [(D(2024, 1, 5), D(2024, 1, 1), "b1", "t1", True, False, 3),
          (D(2024, 2, 7), D(2024, 2, 1), "b1", "t1", False, True, None)]
    refresh_mart(wh, spark.createDataFrame(v1, schema), dim_b, dim_t, AS_OF, [D(2024, 1, 1), D(2024, 2, 1)])
    january = lambda: {r[0] for r in wh.mart_table().read().where("_month = '2024-01-01'").select(F.input_file_name()).collect()}
    before = january()
    f2 = spark.createDataFrame(v1 + [(D(2024, 2, 8), D(2024, 2, 1), "b1", "t1", True, False, 5)], schema)
    mart = refresh_mart(wh, f2, dim_b, dim_t, AS_OF, [D(2024, 2, 1)])
    assert january() == before
    want = daily_summary(f2, dim_b, dim_t, AS_OF)
    assert _rows(mart.select(*want.columns)) == _rows(want)
    mart2 = refresh_mart(wh, f2, dim_b, dim_t.withColumn("category", F.lit("Housing")), AS_OF, [], rebuild=True)
    assert january() != before and {r.category for r in mart2.collect()} == {"Housing"}


def test_observed_values_follow_silver(spark):
    """A value whose last request moves to another one, or loses its date, is gone, as in a full build; a repeat changes nothing."""
    wh = Warehouse(spark, scratch_path(spark, "wh_observed"))
    table = wh.silver_latest_table()

    def merge(rows):
        df = spark.createDataFrame(rows, "complaint_id string, created_at timestamp, borough string, complaint_type string, v int")
        df = df.withColumn("_created_month", F.trunc(F.to_date("created_at"), "month"))
        pick = lambda d: latest_per_key(d, ["complaint_id"], [F.col("v").desc()])
        change = table.prepare_merge_latest(df, ["complaint_id"], pick)
        change.publish()
        held = refresh_observed(wh, change)
        assert change.after().count() == table.read().count()
        return {c: sorted({r[0] for r in df.distinct().collect()}) for c, df in held.items()}

    jan, feb = dt.datetime(2024, 1, 5), dt.datetime(2024, 2, 5)
    assert merge([("1", jan, "A", "x", 1), ("2", jan, "B", "x", 1), ("3", feb, "A", None, 1)]) == {"borough": ["A", "B"], "complaint_type": ["x"]}
    second = [("2", feb, "C", "y", 2)]  # B's last request moves month and borough
    assert merge(second) == merge(second) == {"borough": ["A", "C"], "complaint_type": ["x", "y"]}
    assert merge([("1", None, "A", "x", 2), ("4", jan, None, None, 1)]) == {"borough": ["A", "C"], "complaint_type": ["y"]}
    assert merge([]) == {"borough": ["A", "C"], "complaint_type": ["y"]}


def test_dimensions_are_written_when_their_content_changes(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh_dim"))
    mk = lambda v, t: spark.createDataFrame([("k", v, t)], "sk string, v string, dim_loaded_at string")
    assert refresh_dim(wh, "d", mk("a", "1"))[1] and not refresh_dim(wh, "d", mk("a", "2"))[1] and refresh_dim(wh, "d", mk("b", "3"))[1]
    assert wh.read("gold", "d").first().v == "b"


def test_incremental_history_equals_full_bronze_snapshots(spark):
    wh = Warehouse(spark, scratch_path(spark, "wh_hist"))
    b1, b2 = sr_bronze(spark, SF, (1,)), sr_bronze(spark, SF, (2,))
    late = b1.filter(F.col("filename").contains("batch0.json")).withColumn(
        "_extracted_at", F.lit("2024-02-02 06:00:00").cast("timestamp_ntz"))
    times = ["2024-03-01 00:00:00", "2024-03-02 00:00:00", "2024-03-03 00:00:00"]
    lazy, seen = None, None
    for b, t in zip([b1, b2, late], times):
        wh.history_store().publish(history_input(b, with_filename=True), t,
                                   lambda current, new: snapshot_requests(current, newer_than_seen(current, new), t))
        seen = b if seen is None else seen.unionByName(b)
        lazy = request_history(lazy, seen, t)
    assert _rows(wh.history_store().read()) == _rows(lazy)


def test_freshness_with_known_mark(spark):
    from civicflow.operators.freshness import freshness
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    none_new = df.filter("false")
    r = freshness(none_new, "t", "2024-01-02 00:00:00", known_max="2024-01-01 12:00:00").first()
    assert str(r.max_loaded_at) == "2024-01-01 12:00:00" and r.status == "pass"
    r2 = freshness(df, "t", "2024-01-03 00:00:00", known_max="2023-12-31 00:00:00").first()
    assert str(r2.max_loaded_at) == "2024-01-01 00:00:00" and r2.status == "warn"
