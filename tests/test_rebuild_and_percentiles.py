"""History rebuilt in one pass, percentiles by weight, page seeks, and merges with awkward keys and partitions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from civicflow.operators.history import snapshot_check, snapshot_runs
from civicflow.operators.incremental import unique_source
from civicflow.operators.ranking import exact_percentiles, numbered, sorted_and_stored
from civicflow.sources.paging import PageIndex
from civicflow.sources.tables import HistoryStore, PartitionedTable

AT = "2024-01-{:02d} 00:00:00"


def test_one_pass_equals_run_after_run(spark):
    """Late older files, unchanged and returning values, NULLs, and keys that some runs don't deliver."""
    rng, data = random.Random(2), []
    for key in "abcdefghij":
        for run in range(1, 9):
            if rng.random() < 0.7:
                data.append((key, run, AT.format(run), rng.choice(["x", "y", None]), rng.choice([1, 2]), f"f{rng.randrange(6)}"))
    states = spark.createDataFrame(data, "k string, run long, run_at string, v string, n int, file string").withColumn("_file", F.col("file"))
    history = None
    for run in range(1, 9):
        src = states.where(F.col("run") == run)
        if history is not None:
            held = history.where("valid_to is null").select("k", F.col("_file").alias("seen"))
            src = src.join(held, "k", "left").where("seen is null or _file >= seen")
        history = spark.createDataFrame(snapshot_check(history, src, "k", ["v", "n"], AT.format(run), carry=["_file"]).collect(),
                                        "k string, v string, n int, scd_id string, updated_at timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz, _file string")
    got = snapshot_runs(states, "k", ["v", "n"], newest=("file",), carry=("_file",))
    rows = lambda df: sorted(map(str, df.drop("_file").collect()))
    assert rows(got) == rows(history) and got.where("valid_to is not null").count() > 10
    open_files = lambda df: sorted(map(str, df.where("valid_to is null").select("k", "_file").collect()))
    assert open_files(got) == open_files(history)


def test_a_key_with_thousands_of_deliveries(spark):
    data = spark.range(5000).select(F.lit("hot").alias("k"), (F.col("id") + 1).alias("run"), F.date_format(F.timestamp_seconds(F.col("id") * 60), "yyyy-MM-dd HH:mm:ss").alias("run_at"),
                                    (F.col("id") % 3 == 0).cast("int").alias("v"), F.format_string("f%05d", "id").alias("file"))
    got = snapshot_runs(data, "k", ["v"], newest=("file",))
    assert got.count() == sum(1 for i in range(5000) if i == 0 or (i % 3 == 0) != ((i - 1) % 3 == 0))
    assert got.where("valid_to is null").count() == 1 and got.where("valid_from >= valid_to").count() == 0


def test_a_rebuild_that_fails_leaves_the_history(spark, tmpdir_path):
    store = HistoryStore(spark, os.path.join(tmpdir_path, "h"), key="k", buckets=4)
    src = lambda v: spark.createDataFrame([("a", v), ("b", "same")], "k string, v string")
    for run, v in ((1, "x"), (2, "y")):
        store.publish(src(v), AT.format(run), lambda cur, new, at=AT.format(run): snapshot_check(cur, new, "k", ["v"], at))
    before = sorted(map(str, store.read().collect()))
    bad = store.read().withColumn("v", F.when(F.col("k") == "a", F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        store.rebuild(bad)
    assert sorted(map(str, store.read().collect())) == before
    store.rebuild(store.read())
    assert sorted(map(str, store.read().collect())) == before and len(before) == 3
    store.publish(src("z"), AT.format(3), lambda cur, new: snapshot_check(cur, new, "k", ["v"], AT.format(3)))
    assert store.read().count() == 4 and store.read().where("valid_to is null").count() == 2


def _percentile(values, p):
    values, at = sorted(values), (len(values) - 1) * p
    low = values[int(at)]
    return low + (values[min(int(at) + 1, len(values) - 1)] - low) * (at - int(at))


def test_percentiles_with_a_hot_value(spark):
    """One value in a third of the rows is one weighted row, so tasks stay even."""
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([7.5] * 5 + [round(rng.uniform(0, 50), 3) for _ in range(10)])) for _ in range(3000)]
    data += [("one", 3.25), ("two", 1.0), ("two", 2.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = {r.g: (r.p0, r.p50, r.p90, r.p100) for r in exact_percentiles(df, "g", "v", {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p100": 1.0}).collect()}
    by = {}
    for g, v in data:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert got == {g: pytest.approx(tuple(_percentile(vs, p) for p in (0, 0.5, 0.9, 1))) for g, vs in by.items()}
    counts = df.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("n"))
    parts = [r["count"] for r in sorted_and_stored(counts, [F.col("g"), F.col("v")], "even", 8).groupBy("__part").count().collect()]
    assert len(parts) == 8 and max(parts) <= 3 * min(parts)


def test_equal_sort_keys_are_spread(spark):
    df = spark.range(4000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    parts = [r["count"] for r in sorted_and_stored(df, [F.col("k")], "ties", 8).groupBy("__part").count().collect()]
    assert len(parts) == 8 and max(parts) <= 2 * min(parts)
    assert sorted(r.rank for r in numbered(df, [F.col("k")]).collect()) == list(range(1, 4001))


def test_a_deep_page_reads_few_partitions(spark):
    df = spark.range(10_000).select(F.expr("id % 97").alias("ts"), F.col("id").alias("key"), F.lit("x").alias("other"))
    want = [r.key for r in df.orderBy(F.desc("ts"), "key").collect()]
    index = PageIndex(df, "ts", "key", partitions=20)
    for limit, offset in ((100, 0), (100, 9000), (1000, 8950), (50, 9980), (10, 10_000), (10_000, 0)):
        page = index.page(limit, offset)
        assert [r.key for r in page.collect()] == want[offset:offset + limit] and page.columns == df.columns
    files = index.page(100, 9000).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 2 and index.rows.select(F.input_file_name().alias("f")).distinct().count() == 20


def test_partition_values_that_folder_names_escape(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "odd"), "p")
    df = lambda rows: spark.createDataFrame(rows, "id int, p string")
    odd = ["a/b", "x=y", "50%", "c:d", "plain", "sp ace"]
    t.merge(df(list(enumerate(odd))), ["id"])
    t.merge(df([(i, "moved") for i in range(6)]), ["id"])
    assert sorted((r.id, r.p) for r in t.read().collect()) == [(i, "moved") for i in range(6)]


def test_null_keys_are_no_duplicates_and_no_group(spark):
    df = spark.range(1000).select(F.when(F.col("id") > 900, F.col("id")).alias("k"), F.col("id").alias("v"))
    out = unique_source(df, ["k"])
    assert out.columns == ["k", "v"] and out.count() == 1000
    with pytest.raises(Exception, match="duplicate source key: 950"):
        unique_source(df.withColumn("k", F.when(F.col("v") > 948, 950)), ["k"]).collect()
