"""Landing files, lineage, bronze defaults, streaming pickup."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from civicflow.plans.history import history_input
from civicflow.plans.staging import base
from civicflow.sources.bronze import to_bronze
from civicflow.sources.landing import landing_inventory, landing_rejects, read_landing, write_landing
from civicflow.sources.tables import layer_name, read_table, write_table
from civicflow.streaming.ingest import ingest_available


def _land(root, day, name, records):
    os.makedirs(os.path.join(root, day), exist_ok=True)
    with open(os.path.join(root, day, name), "w") as fh:
        json.dump(records, fh, indent=3)


def _write(root, day, name, text):
    os.makedirs(os.path.join(root, day), exist_ok=True)
    with open(os.path.join(root, day, name), "w") as fh:
        fh.write(text)


def test_array_files_to_bronze_with_lineage(spark, tmpdir_path):
    _land(tmpdir_path, "2024-02-01", "batch0_2024-02-01_05-00-00.json",
          [{"unique_key": "1", "status": "OPEN", "extra": 5}, {"unique_key": None, "created_date": "x"}, {}])
    _land(tmpdir_path, "2024-02-02", "batch0_2024-02-02_05-00-00.json", [{"unique_key": " 2", "latitude": 40.5}])
    b = to_bronze(read_landing(spark, tmpdir_path, "array"), "2024-02-03 00:00:00")
    rows = b.orderBy("filename").collect()
    assert len(rows) == 4
    assert {r.filename for r in rows} == {"2024-02-01/batch0_2024-02-01_05-00-00.json",
                                          "2024-02-02/batch0_2024-02-02_05-00-00.json"}
    assert all(r._source_relation == "S3" and str(r._extracted_at) == "2024-02-03 00:00:00" for r in rows)
    flat = base(b).orderBy("source_filename", "complaint_id").collect()
    assert [r.latitude for r in flat if r.complaint_id == " 2"][0] is not None
    # a JSON null key is present (kept); an absent key is filtered.
    hist = history_input(b).collect()
    assert sorted((r.complaint_id or "<null>") for r in hist) == [" 2", "1", "<null>"]


def test_a_null_payload_or_file_name_fails_the_load(spark):
    df = spark.createDataFrame([("a", None), ("a", "f")], "p string, filename string") \
        .select(F.parse_json(F.lit('{"a":1}')).alias("raw_data"), "filename")
    assert to_bronze(df.where("filename is not null"), "2024-01-01 00:00:00").count() == 1
    with pytest.raises(Exception, match="bronze.filename is NULL"):
        to_bronze(df, "2024-01-01 00:00:00").collect()
    with pytest.raises(Exception, match="bronze.raw_data is NULL"):
        to_bronze(df.where("filename is not null").withColumn("raw_data", F.lit(None).cast("variant"))).collect()


def test_malformed_input_fails_the_load_and_is_listed(spark, tmpdir_path):
    _land(tmpdir_path, "good", "a.json", [{"unique_key": "1"}])
    _write(tmpdir_path, "deep/er", "cut.json", '[{"unique_key": "2"}, {"unique_key":')
    _write(tmpdir_path, "deep/er", "object.json", '{"unique_key": "3"')
    assert sorted(r.filename for r in landing_rejects(spark, tmpdir_path).collect()) == ["deep/er/cut.json", "deep/er/object.json"]
    with pytest.raises(Exception):
        read_landing(spark, tmpdir_path, "array").collect()
    lines = os.path.join(tmpdir_path, "lines")
    _write(lines, "d", "l.json", '{"unique_key": "1"}\n\n{"unique_key": \n{"unique_key": "2"}\n')
    assert [r.filename for r in landing_rejects(spark, lines, "lines").collect()] == ["d/l.json"]
    with pytest.raises(Exception):
        read_landing(spark, lines, "lines").collect()


@pytest.mark.parametrize("blank", [" " * 70, "\n" * 65, "\t \r\n" * 5000])
def test_an_array_after_much_white_space_is_an_array(spark, tmpdir_path, blank):
    _write(tmpdir_path, "d", "a.json", blank + '[{"unique_key": "1"}, {"unique_key": "2"}]')
    _write(tmpdir_path, "d", "one.json", blank + '{"unique_key": "3", "list": [1]}')
    got = read_landing(spark, tmpdir_path, "array").select(F.expr("try_variant_get(raw_data, '$.unique_key', 'string')").alias("k")).collect()
    assert sorted(r.k or "" for r in got) == ["1", "2", "3"]
    _write(tmpdir_path, "d", "cut.json", blank + '[{"unique_key": "4"}, {"unique_key":')
    assert [r.filename for r in landing_rejects(spark, tmpdir_path).collect()] == ["d/cut.json"]


BIG = """
import sys
from pyspark.sql import SparkSession, functions as F
from civicflow.sources.landing import read_landing
spark = (SparkSession.builder.master("local[2]").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").getOrCreate())
got = read_landing(spark, sys.argv[1], "array")
print("GOT", *got.select(F.variant_get("raw_data", "$.unique_key", "long").alias("k")).agg(F.count("k"), F.sum("k")).first())
"""


def test_an_array_file_beyond_the_variant_limit_loads_whole(tmpdir_path):
    """In a process of its own: a file needs a few times its size in memory."""
    n, pad = 70_000, "x" * 2000
    with open(os.path.join(tmpdir_path, "a.json"), "w") as fh:
        fh.write("[" + ",".join(f'{{"unique_key":"{i}","pad":"{pad}"}}' for i in range(n)) + "]")
    assert os.path.getsize(os.path.join(tmpdir_path, "a.json")) > 128 << 20
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", BIG, tmpdir_path], capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": root})
    assert f"GOT {n} {n * (n - 1) // 2}" in out.stdout, out.stderr[-2000:]


def test_streams_read_deep_folders_and_keep_each_others_loads(spark, tmpdir_path):
    land, bronze = os.path.join(tmpdir_path, "land"), os.path.join(tmpdir_path, "bronze")
    _land(land, "a/b/c", "x.json", [{"unique_key": "1"}, {"unique_key": "2"}])
    for i in range(2):
        ingest_available(spark, land, bronze, os.path.join(tmpdir_path, f"ckpt{i}"), "2024-02-01 05:00:00")
    assert spark.read.option("recursiveFileLookup", "true").parquet(bronze).count() == 4


def test_a_backlog_is_split_into_batches(spark, tmpdir_path):
    land, bronze, ckpt = (os.path.join(tmpdir_path, x) for x in ("land", "bronze", "ckpt"))
    for i in range(5):
        _land(land, "d", f"{i}.json", [{"unique_key": str(i)}])
    assert ingest_available(spark, land, bronze, ckpt, "2024-02-01 05:00:00", max_files_per_trigger=2) == 3
    assert spark.read.option("recursiveFileLookup", "true").parquet(bronze).count() == 5


def test_a_large_backlog_comes_in_a_bounded_number_of_batches(spark, tmpdir_path):
    land, bronze, ckpt = (os.path.join(tmpdir_path, x) for x in ("land", "bronze", "ckpt"))
    for i in range(20):
        _land(land, f"d/{i % 3}", f"{i}.json", [{"unique_key": str(i)}])
    assert ingest_available(spark, land, bronze, ckpt, "2024-02-01 05:00:00", max_files_per_trigger=1, max_batches=4) == 4
    rows = spark.read.option("recursiveFileLookup", "true").parquet(bronze)
    assert sorted(int(r[0]) for r in base(rows).select("complaint_id").collect()) == list(range(20))
    _land(land, "d", "20.json", [{"unique_key": "20"}])
    assert ingest_available(spark, land, bronze, ckpt, "2024-02-01 05:00:00", max_files_per_trigger=1, max_batches=4) == 1


def test_streamed_queries_batches_do_not_grow_with_the_backlog(spark, tmpdir_path, monkeypatch):
    from civicflow.catalog import queries_io as Q

    seen = []

    def landed(spark, sf_dir, root, drops=(1, 2)):
        for i in range(60):
            _land(root.removeprefix("file:"), "d", f"{i}.json", [{"unique_key": str(i), "status": "Open"}])

    def counted(*a, **k):
        seen.append(ingest_available(*a, **k))

    monkeypatch.setattr(Q, "land_arrays", landed)
    monkeypatch.setattr(Q, "ingest_available", counted)
    assert Q.q_stream_two_checkpoints(spark, tmpdir_path).where("loads = 2").count() == 60
    assert all(1 < n <= Q.MAX_BATCHES for n in seen) and len(seen) == 2


def test_json_lines_writer_round_trip_and_inventory(spark, tmpdir_path):
    recs = spark.createDataFrame([(str(i), "2024-02-01" if i % 2 else "2024-02-02", None if i == 3 else "v")
                                  for i in range(10)], "unique_key string, ingest_date string, status string")
    write_landing(recs, tmpdir_path, max_records_per_file=2)
    back = read_landing(spark, tmpdir_path, "lines")
    assert back.count() == 10
    assert back.filter(F.col("filename").contains(":")).count() == 0
    inv = {r.landing_date: r.files for r in landing_inventory(spark, tmpdir_path).collect()}
    assert set(inv) == {"2024-02-01", "2024-02-02"} and all(n >= 3 for n in inv.values())


def test_stream_loads_each_file_once(spark, tmpdir_path):
    land, bronze, ckpt = (os.path.join(tmpdir_path, x) for x in ("land", "bronze", "ckpt"))
    _land(land, "2024-02-01", "a.json", [{"unique_key": "1"}, {"unique_key": "2"}])
    assert ingest_available(spark, land, bronze, ckpt, "2024-02-01 05:00:00") >= 1
    assert ingest_available(spark, land, bronze, ckpt, "2024-02-01 06:00:00") == 0  # nothing new
    _land(land, "2024-02-02", "b.json", [{"unique_key": "3"}])
    ingest_available(spark, land, bronze, ckpt, "2024-02-02 05:00:00")
    rows = spark.read.option("recursiveFileLookup", "true").parquet(bronze).collect()
    assert len(rows) == 3
    assert sorted(r.filename for r in rows) == ["2024-02-01/a.json", "2024-02-01/a.json", "2024-02-02/b.json"]


def test_versioned_table_and_layer_routing(spark, tmpdir_path):
    assert layer_name(" gold ", "default") == "gold" and layer_name(None, "default") == "default"
    t = os.path.join(tmpdir_path, "t")
    write_table(spark.range(3), t)
    first = read_table(spark, t)
    write_table(first.withColumn("id", F.col("id") + 10), t)  # reads v1 while writing v2
    assert sorted(r.id for r in read_table(spark, t).collect()) == [10, 11, 12]


def test_continuous_trigger_processes_new_files(spark, tmpdir_path):
    import time
    land, bronze, ckpt = (os.path.join(tmpdir_path, x) for x in ("land", "bronze", "ckpt"))
    _land(land, "2024-02-01", "a.json", [{"unique_key": "1"}])
    q = ingest_available(spark, land, bronze, ckpt, None, processing_time="1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not os.path.exists(os.path.join(bronze, f"query={q.id}", "batch=0")):
            time.sleep(0.5)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.option("recursiveFileLookup", "true").parquet(bronze).collect()
    assert len(rows) == 1 and rows[0]._extracted_at is not None


def test_single_object_file_is_one_record(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "2024-02-03"))
    with open(os.path.join(tmpdir_path, "2024-02-03", "one.json"), "w") as fh:
        json.dump({"unique_key": "9"}, fh)
    _land(tmpdir_path, "2024-02-04", "two.json", [{"unique_key": "10"}, {"unique_key": "11"}])
    keys = sorted(r.k for r in read_landing(spark, tmpdir_path, "array")
                  .selectExpr("try_variant_get(raw_data, '$.unique_key', 'string') as k").collect())
    assert keys == ["10", "11", "9"]


def test_clean_scratch_only_removes_old_folders(spark):
    from civicflow.session import clean_scratch, scratch_path
    p = scratch_path(spark, "probe")
    spark.range(1).write.parquet(p)
    assert os.path.basename(p) not in clean_scratch(spark, older_than_seconds=3600)
    assert os.path.basename(p) in clean_scratch(spark, older_than_seconds=0)
