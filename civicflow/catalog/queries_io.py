"""Landing, streaming and whole-run queries.  Each writes the SR fixture (derived
from ``events``) into a fresh folder under the shared checkpoint directory."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from civicflow.operators.quality import CheckFailed
from civicflow.plans.run import Warehouse, build_pending, run_all
from civicflow.plans.staging import base
from civicflow.session import scratch_path
from civicflow.sources.bronze import to_bronze
from civicflow.sources.landing import landing_inventory, landing_rejects, read_landing, write_landing, write_landing_arrays
from civicflow.sources.tables import layer_path, read_table
from civicflow.sources.service_requests import (AS_OF, DROP_LOADED_AT, PAYLOAD_KEYS,
                                                service_request_records)
from civicflow.streaming.ingest import ingest_available

DAYS = {1: "2024-02-01", 2: "2024-02-02"}
MAX_BATCHES = 8  # of a streamed backlog, whatever its size; smaller ones come in four files a batch


def _records(spark, sf_dir, **fixture):
    from civicflow.catalog.queries import _prepare, table
    _prepare(spark)
    return service_request_records(table(spark, sf_dir, "events"), **fixture)


def land_arrays(spark, sf_dir, root: str, drops=(1, 2)) -> None:
    """Land the SR fixture as one JSON-array file per source page, one folder per day.

    A page is (drop, event_id bucket of 1000): at most 1000 records.
    """
    rec = _records(spark, sf_dir).withColumn("page", F.regexp_extract("filename", r"/(batch\d+)\.json$", 1))
    for d in drops:
        write_landing_arrays(rec.filter(F.col("drop_no") == d), os.path.join(root, DAYS[d]), "page",
                             list(PAYLOAD_KEYS))


def write_large_array(records, root: str) -> None:
    """Land all records as one JSON-array file, as a bulk export does: the writer streams them in one task."""
    bare = records.coalesce(1).select(F.to_json(F.struct("*")).alias("value")).withColumn("at", F.monotonically_increasing_id())
    lines = bare.select(F.concat(F.when(F.col("at") == 0, "[").otherwise(","), F.col("value")).alias("value"))
    end = records.sparkSession.range(1).select(F.lit("]").alias("value"))
    lines.unionByName(end).coalesce(1).write.mode("append").text(root)


def _parsed(bronze):
    b = base(bronze)
    return b.select("complaint_id", "created_at", "closed_at", "agency_code", "complaint_type", "status",
                    "incident_zip", "borough", "latitude", "longitude", "submission_channel", "extracted_at",
                    F.regexp_extract("source_filename", r"(\d{4}-\d{2}-\d{2})", 1).alias("landing_day"))


def q_landing_arrays(spark, sf_dir):
    """S1 + S2 + S3: array files -> bronze rows with lineage and per-load defaults."""
    root = scratch_path(spark, "landing_arrays")
    land_arrays(spark, sf_dir, root)
    parts = [to_bronze(read_landing(spark, os.path.join(root, DAYS[d]), "array"), DROP_LOADED_AT[d])
             .withColumn("filename", F.concat(F.lit(DAYS[d] + "/"), F.col("filename"))) for d in (1, 2)]
    return _parsed(parts[0].unionByName(parts[1]))


def q_landing_split(spark, sf_dir):
    """Each drop lands as one large array file, and many tasks read its records."""
    root = scratch_path(spark, "landing_split")
    rec, parts = _records(spark, sf_dir), []
    for d in (1, 2):
        day = os.path.join(root, DAYS[d])
        write_large_array(rec.filter(F.col("drop_no") == d).select(*PAYLOAD_KEYS), day)
        parts.append(to_bronze(read_landing(spark, day, "array", split_bytes=0), DROP_LOADED_AT[d])
                     .withColumn("filename", F.concat(F.lit(DAYS[d] + "/"), F.col("filename"))))
    return _parsed(parts[0].unionByName(parts[1]))


def q_landing_lines(spark, sf_dir):
    """S5 + S1: records written as JSON lines under date prefixes, then read back."""
    root = scratch_path(spark, "landing_lines")
    rec = _records(spark, sf_dir).withColumn("ingest_date", F.to_date("extracted_at"))
    write_landing(rec.select(*PAYLOAD_KEYS, "ingest_date"), root)
    bronze = read_landing(spark, root, "lines")
    day = F.regexp_extract("filename", r"(\d{4}-\d{2}-\d{2})", 1)
    bronze = to_bronze(bronze.withColumn(
        "_extracted_at", F.concat(day, F.lit(" 05:00:00")).cast("timestamp_ntz")), None)
    return _parsed(bronze)


def q_landing_inventory(spark, sf_dir):
    """Files per landing day (their bytes depend on the writer)."""
    root = scratch_path(spark, "landing_inventory")
    land_arrays(spark, sf_dir, root)
    return landing_inventory(spark, root).select("landing_date", "files")


def q_landing_rejects(spark, sf_dir):
    """A landing zone with truncated files next to good ones, some in deeper folders: which texts a load refuses.

    Every fourth page lands cut in half, every third page two folders deeper.
    """
    root = scratch_path(spark, "landing_rejects")
    rec = _records(spark, sf_dir).withColumn("page", F.regexp_extract("filename", r"/batch(\d+)\.json$", 1).cast("long"))
    pages = rec.groupBy("drop_no", "page").agg(F.to_json(F.collect_list(F.struct("unique_key", "status"))).alias("value"))
    cut = F.when(F.col("page") % 4000 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    for depth, which in (("flat", F.col("page") % 3000 != 0), ("deep/er", F.col("page") % 3000 == 0)):
        pages.where(which).select(cut.alias("value")).write.option("maxRecordsPerFile", 1).mode("append").text(os.path.join(root, depth))
    rejects = landing_rejects(spark, root)
    return rejects.groupBy(F.when(F.col("filename").startswith("deep/"), "deep").otherwise("flat").alias("folder")).agg(
        F.count("*").alias("rejected"))


def q_stream_two_checkpoints(spark, sf_dir):
    """A stream started again with a new checkpoint loads everything once more and keeps the first load."""
    root, bronze_dir = scratch_path(spark, "stream_landing"), scratch_path(spark, "stream_bronze")
    land_arrays(spark, sf_dir, os.path.join(root, "region", "a"))
    for _ in range(2):
        ingest_available(spark, root, bronze_dir, scratch_path(spark, "stream_ckpt"), DROP_LOADED_AT[1], max_files_per_trigger=4, max_batches=MAX_BATCHES)
    rows = base(spark.read.option("recursiveFileLookup", "true").parquet(bronze_dir))
    return rows.groupBy("complaint_id").agg(F.count("*").alias("loads"), F.max("status").alias("status"))


def q_stream_bronze(spark, sf_dir):
    """Two drops land; each availableNow run loads only the new files."""
    root = scratch_path(spark, "stream_landing")
    bronze_dir = scratch_path(spark, "stream_bronze")
    ckpt = scratch_path(spark, "stream_ckpt")
    for d in (1, 2):
        land_arrays(spark, sf_dir, root, drops=(d,))
        ingest_available(spark, root, bronze_dir, ckpt, DROP_LOADED_AT[d])
    return _parsed(spark.read.option("recursiveFileLookup", "true").parquet(bronze_dir))


def _two_drop_run(spark, sf_dir, streaming: bool, on_error: str = "continue"):
    """Two runs over the SR fixture.  The fixture deliberately holds closings
    before creation, which an ``error`` check reports; the registered queries
    publish and report (``continue``), the default run mode would stop there."""
    root = scratch_path(spark, "run_landing")
    wh = Warehouse(spark, scratch_path(spark, "warehouse"))
    ckpt = scratch_path(spark, "run_ckpt")
    for d in (1, 2):
        land_arrays(spark, sf_dir, root, drops=(d,))
        if streaming:
            # A drop comes in several micro-batches; the build runs once over those not built yet
            # (high-water mark + merge into the fact, history snapshot).
            ingest_available(spark, root, wh.bronze_dir, ckpt, DROP_LOADED_AT[d], max_files_per_trigger=4, max_batches=MAX_BATCHES)
            build_pending(wh, AS_OF, history_at=DROP_LOADED_AT[d], on_error=on_error)
        else:
            bronze = to_bronze(read_landing(spark, os.path.join(root, DAYS[d]), "array"), DROP_LOADED_AT[d]) \
                .withColumn("filename", F.concat(F.lit(DAYS[d] + "/"), F.col("filename")))
            bronze.write.mode("append").parquet(os.path.join(wh.bronze_dir, f"load={d}"))
            run_all(wh, AS_OF, history_at=DROP_LOADED_AT[d], on_error=on_error)
    return wh


def q_stream_fact(spark, sf_dir):
    """Fact after two streamed drops, merged incrementally per micro-batch."""
    wh = _two_drop_run(spark, sf_dir, streaming=True)
    return wh.fact_table().read()


def q_stream_history(spark, sf_dir):
    """T4: the stored history after two streamed drops."""
    return _two_drop_run(spark, sf_dir, streaming=True).history_store().read()


def _gated_run(spark, sf_dir, layers=None):
    """One whole run in the default mode, in which an ``error`` check with failures would stop it, over records
    whose closings are repaired."""
    root = scratch_path(spark, "gated_landing")
    wh = Warehouse(spark, scratch_path(spark, "gated_warehouse"), layers)
    rec = _records(spark, sf_dir, repaired=True).withColumn("ingest_date", F.to_date("extracted_at"))
    write_landing(rec.select(*PAYLOAD_KEYS, "ingest_date"), root)
    day = F.regexp_extract("filename", r"(\d{4}-\d{2}-\d{2})", 1)
    bronze = read_landing(spark, root, "lines").withColumn("_extracted_at", F.concat(day, F.lit(" 05:00:00")).cast("timestamp_ntz"))
    to_bronze(bronze).write.parquet(wh.bronze_dir)
    return wh, run_all(wh, AS_OF)


def q_gated_run(spark, sf_dir):
    """P12 + Q12: a gated run over repaired records passes; returns its daily mart."""
    wh, _ = _gated_run(spark, sf_dir)
    return wh.mart_table().read().drop("_month")


def q_severities(spark, sf_dir):
    """Q12: the same run's check results by severity: errors have no failures, warnings may and don't stop it."""
    _, products = _gated_run(spark, sf_dir)
    return products["checks"].groupBy("severity").agg((F.sum("failures") > 0).alias("failing"))


def q_custom_layers(spark, sf_dir):
    """Products land in the layers that the caller names (trimmed, otherwise verbatim)."""
    wh, _ = _gated_run(spark, sf_dir, {"gold": " reporting ", "silver": "Stage-2"})
    return read_table(spark, layer_path(wh.root, " reporting ", "dim_request_type"))


def q_full_run(spark, sf_dir):
    """Two scheduled runs (drop 1, then drop 2); returns the published daily mart."""
    wh = _two_drop_run(spark, sf_dir, streaming=False)
    return wh.mart_table().read().drop("_month")


def q_full_run_history(spark, sf_dir):
    """P12 + S14: the stored type-2 history after two scheduled runs (closed versions appended)."""
    wh = _two_drop_run(spark, sf_dir, streaming=False)
    return wh.history_store().read()


def stopped_run(spark, sf_dir):
    """Loads with closings before creation, which a check refuses, one after the other: the runs stop until a third
    load redelivers the faulty requests.  Returns the warehouse and the number of stops."""
    from civicflow.catalog.queries import _prepare, table
    from civicflow.sources.service_requests import service_request_bronze
    _prepare(spark)
    wh, stops = Warehouse(spark, scratch_path(spark, "stopped_warehouse")), 0
    staged = scratch_path(spark, "stopped_loads")
    service_request_bronze(table(spark, sf_dir, "events"), (1, 2, 3)).write.parquet(staged)
    bronze = spark.read.parquet(staged)
    for load in (1, 2, 3):
        bronze.where(F.col("_extracted_at") == F.lit(DROP_LOADED_AT[load]).cast("timestamp_ntz")).write.parquet(os.path.join(wh.bronze_dir, f"load={load}"))
        try:
            run_all(wh, AS_OF, history_at=DROP_LOADED_AT[3])
        except CheckFailed:
            stops += 1
    return wh, stops


def q_stopped_run(spark, sf_dir):
    """P12 + Q12: the fact after two stopped runs and a good one equals that of one clean run; with the number of stops."""
    wh, stops = stopped_run(spark, sf_dir)
    return wh.fact_table().read().withColumn("stops", F.lit(stops))


def q_stopped_run_mart(spark, sf_dir):
    """P12 + Q12: the daily mart after the same runs."""
    return stopped_run(spark, sf_dir)[0].mart_table().read().drop("_month")


def q_stopped_run_history(spark, sf_dir):
    """P12 + S14: the history after the same runs: no key is lost, and no refused version was published."""
    return stopped_run(spark, sf_dir)[0].history_store().read()


def q_history_full_refresh(spark, sf_dir):
    """I6 + S14: two runs, then a full refresh: the history is rebuilt from all loads with its closed versions."""
    wh = _two_drop_run(spark, sf_dir, streaming=False)
    run_all(wh, AS_OF, full_refresh=True, history_at=DROP_LOADED_AT[3], on_error="continue")
    return wh.history_store().read()


def q_fact_full_refresh(spark, sf_dir):
    """A full refresh ignores the stored fact and its high-water mark."""
    from civicflow.catalog.queries import sr_bronze
    from civicflow.plans.build import GoldBuild, materialize
    run1 = materialize(GoldBuild(spark, sr_bronze(spark, sf_dir, (1,)), AS_OF).fact, "fact_run1")
    return GoldBuild(spark, sr_bronze(spark, sf_dir, (1, 2)), AS_OF, target_fact=run1, full_refresh=True).fact


def q_request_history_as_of(spark, sf_dir):
    """Request versions current between the two history runs."""
    from civicflow.catalog.queries_extra import HISTORY_PROBE, q_request_history
    from civicflow.operators.history import as_of
    return as_of(q_request_history(spark, sf_dir), HISTORY_PROBE)


def extra() -> dict:
    return {
        "s1_landing_arrays": q_landing_arrays,
        "s1_landing_split_arrays": q_landing_split,
        "s5_landing_lines": q_landing_lines,
        "s11_landing_inventory": q_landing_inventory,
        "t1_stream_bronze": q_stream_bronze,
        "s1_landing_rejects": q_landing_rejects,
        "t1_stream_two_checkpoints": q_stream_two_checkpoints,
        "t2_stream_fact": q_stream_fact,
        "t4_stream_history": q_stream_history,
        "p12_gated_run": q_gated_run,
        "q12_severities": q_severities,
        "s10_custom_layers": q_custom_layers,
        "p12_full_run": q_full_run,
        "p12_full_run_history": q_full_run_history,
        "p12_stopped_run": q_stopped_run,
        "p12_stopped_run_mart": q_stopped_run_mart,
        "p12_stopped_run_history": q_stopped_run_history,
        "i6_fact_full_refresh": q_fact_full_refresh,
        "i6_history_full_refresh": q_history_full_refresh,
        "i7_request_history_as_of": q_request_history_as_of,
    }
