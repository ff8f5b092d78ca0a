"""Runs that stop, are cut short and go on: what a gate refused is never published, and nothing is lost."""

import os

import pytest
from pyspark.sql import functions as F

import civicflow.plans.run as R
from civicflow.catalog.queries import sr_bronze, table
from civicflow.operators.quality import CheckFailed, expression_is_true
from civicflow.plans.run import Warehouse, build_pending, pending_loads, run_all
from civicflow.session import scratch_path
from civicflow.sources.service_requests import AS_OF, DROP_LOADED_AT, service_request_bronze
from civicflow.sources.tables import staged
from civicflow.streaming.ingest import ingest_available

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loads(spark):
    """The fixture's loads by number: 1 and 2 hold closings before creation, 3 redelivers those requests repaired."""
    rows = staged(service_request_bronze(table(spark, SF, "events"), (1, 2, 3)), "loads")
    return lambda n: rows.where(F.col("_extracted_at") == F.lit(DROP_LOADED_AT[n]).cast("timestamp_ntz"))


def _warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "ledger_wh"))


def _load(wh, rows, name):
    rows.write.parquet(os.path.join(wh.bronze_dir, f"load={name}"))


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def _products(wh):
    return {"fact": _rows(wh.fact_table().read()), "mart": _rows(wh.mart_table().read()), "history": _rows(wh.history_store().read())}


def test_a_stopped_run_stays_stopped_until_it_is_fixed(spark, loads):
    """Two load stamps, bad rows in the older one too: each run stops, none publishes; then all is as one clean run gives it."""
    wh, late = _warehouse(spark), "2024-02-05 00:00:00"
    _load(wh, loads(1), 1)
    for n in (2, None):
        with pytest.raises(CheckFailed, match="closing_not_before_creation"):
            run_all(wh, AS_OF, history_at=late)
        assert wh.silver_latest_table().read() is None and wh.fact_table().read() is None and wh.history_store().read() is None
        if n:
            _load(wh, loads(n), n)
    _load(wh, loads(3), 3)
    out = run_all(wh, AS_OF, history_at=late)
    clean = _warehouse(spark)
    for n in (1, 2, 3):
        _load(clean, loads(n), n)
    once = run_all(clean, AS_OF, history_at=late)
    assert _products(wh) == _products(clean)
    assert _rows(out["checks"]) == _rows(once["checks"])
    keys = wh.history_store().read().select("complaint_id").distinct().count()
    assert keys == wh.bronze().select(F.expr("variant_get(raw_data, '$.unique_key', 'string')").alias("k")).where("k is not null").distinct().count()
    stops = [(r.run, r["product"]) for r in wh.ledger().rows().where("status = 'stopped'").orderBy("run").collect()]
    assert stops == [(1, "requests_enriched"), (2, "requests_enriched")]


def test_a_late_stop_keeps_what_waits(spark, loads, monkeypatch):
    """A good run, then one that the mart's gate stops: the fact is published, the mart and the history wait and miss nothing,
    also when a load in between shares the stamp of the one before."""
    wh = _warehouse(spark)
    good = sr_bronze(spark, SF, (1, 2), repaired=True)
    stamp = lambda d: good.where(F.col("_extracted_at") == F.lit(DROP_LOADED_AT[d]).cast("timestamp_ntz"))
    half = F.xxhash64("filename", F.col("raw_data").cast("string")) % 2 == 0
    _load(wh, stamp(1), 1)
    run_all(wh, AS_OF, history_at=DROP_LOADED_AT[1])
    before = _rows(wh.mart_table().read())
    _load(wh, stamp(2).where(half), "2a")
    real = R.C.mart_checks
    monkeypatch.setattr(R.C, "mart_checks", lambda: [*real(), expression_is_true("< 0", "total_complaints")])
    with pytest.raises(CheckFailed):
        run_all(wh, AS_OF, history_at="2024-02-02 04:00:00")
    assert _rows(wh.mart_table().read()) == before
    monkeypatch.setattr(R.C, "mart_checks", real)
    _load(wh, stamp(2).where(~half), "2b")  # the same stamp as the mark of silver and fact
    run_all(wh, AS_OF, history_at=DROP_LOADED_AT[2])
    clean = _warehouse(spark)
    _load(clean, stamp(1), 1)
    run_all(clean, AS_OF, history_at=DROP_LOADED_AT[1])
    _load(clean, stamp(2), 2)
    run_all(clean, AS_OF, history_at=DROP_LOADED_AT[2])
    assert _products(wh) == _products(clean)
    files = {r[0] for r in wh.fact_table().read().select(F.input_file_name()).distinct().collect()}
    run_all(wh, AS_OF, history_at="2024-02-09 00:00:00")  # nothing new: nothing is rewritten
    assert {r[0] for r in wh.fact_table().read().select(F.input_file_name()).distinct().collect()} == files
    assert _products(wh) == _products(clean)


def test_a_run_cut_short_in_the_history_is_finished_first(spark, loads, monkeypatch):
    wh, clean = _warehouse(spark), _warehouse(spark)
    for w in (wh, clean):
        _load(w, loads(1), 1)
        run_all(w, AS_OF, history_at=DROP_LOADED_AT[1], on_error="continue")
        _load(w, loads(2), 2)
    real = R.T.PartitionedTable.replace
    monkeypatch.setattr(R.T.PartitionedTable, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):  # closed versions are written, the open ones aren't
        run_all(wh, AS_OF, history_at=DROP_LOADED_AT[2], on_error="continue")
    monkeypatch.setattr(R.T.PartitionedTable, "replace", real)
    run_all(clean, AS_OF, history_at=DROP_LOADED_AT[2], on_error="continue")
    for w in (wh, clean):
        _load(w, loads(3), 3)
        run_all(w, AS_OF, history_at=DROP_LOADED_AT[3], on_error="continue")
    assert _products(wh) == _products(clean)
    # A full refresh rebuilds the history as the runs made it, with its closed versions.
    history = _rows(wh.history_store().read())
    assert any("valid_to=datetime" in r for r in history)
    run_all(wh, AS_OF, full_refresh=True, history_at="2024-02-06 00:00:00", on_error="continue")
    assert _rows(wh.history_store().read()) == history and wh.history_store().dir.endswith("g=000001")
    assert sorted(wh.history_store().drop_old_generations()) == ["closed", "open"] and _rows(wh.history_store().read()) == history


def test_a_backlog_is_built_once(spark, tmpdir_path):
    """Twenty files in twenty micro-batches: one build; a stopped build is made again without new files."""
    wh, root = _warehouse(spark), os.path.join(tmpdir_path, "landing")
    good = sr_bronze(spark, SF, (1,), repaired=True).select(F.to_json("raw_data").alias("value"))
    good.repartition(20).write.text(root)
    ckpt = os.path.join(tmpdir_path, "ckpt")
    assert ingest_available(spark, root, wh.bronze_dir, ckpt, DROP_LOADED_AT[1], layout="lines", max_files_per_trigger=1) == 20
    assert len(pending_loads(wh)) == 20
    real, stop = R.C.staging_checks, [expression_is_true("is null", "complaint_id")]
    R.C.staging_checks = lambda: stop
    try:
        with pytest.raises(CheckFailed):
            build_pending(wh, AS_OF)
    finally:
        R.C.staging_checks = real
    assert len(pending_loads(wh)) == 20
    assert build_pending(wh, AS_OF) is not None and build_pending(wh, AS_OF) is None and pending_loads(wh) == []
    assert wh.ledger().rows().where("product = 'run'").count() == 1
    assert wh.fact_table().read().count() > 500
