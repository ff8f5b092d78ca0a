"""Partition-scoped merges, versions and the stored history."""

import os

import pytest
from pyspark.sql import functions as F

from civicflow.operators.history import snapshot_check
from civicflow.sources.tables import (HistoryStore, PartitionedTable, current_version, drop_old_versions, read_table,
                                      write_table)


def _df(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, m string").withColumn("m", F.col("m").cast("date"))


def _files(table, part):
    folder = os.path.join(table.dir, f"{table.col}={part}")
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) if os.path.isdir(folder) else []


def _rows(table):
    return sorted(((r.id, r.v, None if r.m is None else str(r.m)) for r in table.read().collect()))


def test_merge_rewrites_only_touched_partitions(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "fact"), "m")
    assert t.read() is None and not t.exists()
    t.merge(_df(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-02-01"), (3, "c", "2024-03-01")]), ["id"])
    before = {m: _files(t, m) for m in ("2024-01-01", "2024-02-01", "2024-03-01")}
    # id 2 moves from February (then empty) to April; id 4 is new in April; January and March untouched.
    moved = _df(spark, [(2, "B", "2024-04-01"), (4, "d", "2024-04-01")])
    assert sorted(map(str, t.merge(moved, ["id"]))) == ["2024-02-01", "2024-04-01"]
    assert _files(t, "2024-01-01") == before["2024-01-01"] and _files(t, "2024-03-01") == before["2024-03-01"]
    assert _files(t, "2024-02-01") == []
    want = [(1, "a", "2024-01-01"), (2, "B", "2024-04-01"), (3, "c", "2024-03-01"), (4, "d", "2024-04-01")]
    assert _rows(t) == want
    t.merge(moved, ["id"])  # idempotent
    assert _rows(t) == want


def test_null_partitions_keep_their_other_rows(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "n"), "m")
    t.merge(_df(spark, [(1, "a", None), (2, "b", None), (3, "c", "2024-01-01")]), ["id"])
    t.merge(_df(spark, [(1, "A", None)]), ["id"])
    assert _rows(t) == [(1, "A", None), (2, "b", None), (3, "c", "2024-01-01")]
    t.merge(_df(spark, [(1, "x", "2024-01-01"), (2, "y", "2024-01-01")]), ["id"])
    assert _rows(t) == [(1, "x", "2024-01-01"), (2, "y", "2024-01-01"), (3, "c", "2024-01-01")]


def test_a_duplicated_source_key_raises(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "d"), "m")
    t.merge(_df(spark, [(1, "a", "2024-01-01")]), ["id"])
    with pytest.raises(Exception, match="duplicate source key: 2"):
        t.merge(_df(spark, [(2, "b", "2024-01-01"), (2, "c", "2024-02-01")]), ["id"])
    assert _rows(t) == [(1, "a", "2024-01-01")]


def test_the_source_is_evaluated_once(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "once"), "m")
    t.merge(_df(spark, [(i, "a", "2024-01-01") for i in range(5)]), ["id"])
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    src = _df(spark, [(i, "b", "2024-02-01") for i in range(3, 9)])
    t.merge(src.mapInPandas(count, src.schema), ["id"])
    assert seen.value == 6 and len(_rows(t)) == 9


def test_high_water_mark(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "f"), "m", mark_col="ts")
    mk = lambda rows: spark.createDataFrame(rows, "id int, ts string, m string").select(
        "id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("m").cast("date").alias("m"))
    assert t.mark() is None
    t.merge(mk([(1, "2024-02-01 05:00:00", "2024-01-01")]), ["id"])
    t.merge(mk([(2, "2024-01-15 00:00:00", "2024-01-01")]), ["id"])  # older increment keeps the mark
    assert t.mark() == "2024-02-01 05:00:00"
    t.merge(mk([(1, "2024-02-02 05:00:00", "2024-01-01")]), ["id"])
    assert t.mark() == "2024-02-02 05:00:00"


def test_merge_appends_new_columns(spark, tmpdir_path):
    t = PartitionedTable(spark, os.path.join(tmpdir_path, "evo"), "m")
    t.merge(_df(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-02-01")]), ["id"])
    t.merge(_df(spark, [(2, "B", "2024-02-01")]).withColumn("note", F.lit("new")), ["id"])
    got = sorted((r.id, r.v, str(r.m), r.note) for r in t.read().collect())
    assert got == [(1, "a", "2024-01-01", None), (2, "B", "2024-02-01", "new")]


def test_history_store_replaces_only_seen_buckets(spark, tmpdir_path):
    store = HistoryStore(spark, os.path.join(tmpdir_path, "h"), key="k", buckets=8)
    gens = [[(i, "a") for i in range(20)], [(1, "a"), (2, "B"), (30, "c")], [(2, "BB"), (30, "c")]]
    times = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
    lazy, files = None, None
    for rows, t in zip(gens, times):
        src = spark.createDataFrame(rows, "k int, s string")
        for _ in range(2):  # a repeated run changes nothing
            before = {b: _files(store.open, b) for b in range(8)}
            store.publish(src, t, lambda current, new: snapshot_check(current, new, "k", ["s"], t))
        lazy = snapshot_check(lazy, src, "k", ["s"], t)
        if t == times[1]:
            seen = {r[0] for r in src.select(store.bucket()).distinct().collect()}
            files = {b: _files(store.open, b) for b in range(8)}
            assert all(files[b] == before[b] for b in range(8) if b not in seen) and len(seen) < 8
    assert sorted(tuple(r) for r in store.read().collect()) == sorted(tuple(r) for r in lazy.collect())


def test_versions(spark, tmpdir_path):
    t = os.path.join(tmpdir_path, "plain")
    for n in (2, 5, 7):
        write_table(spark.range(n), t)
    write_table(read_table(spark, t).withColumn("id", F.col("id") + 10), t)  # reads one version, writes the next
    assert sorted(r.id for r in read_table(spark, t).collect()) == list(range(10, 17))
    os.makedirs(os.path.join(t, "v=000009"))  # an unfinished write doesn't count
    assert current_version(spark, t).endswith("v=000004")
    assert drop_old_versions(spark, t, keep=2) == ["v=000001", "v=000002", "v=000003"]
    assert read_table(spark, t).count() == 7


def test_the_history_stages_its_open_versions_once(spark, tmpdir_path, monkeypatch):
    from civicflow.sources import tables as T

    names, real = [], T.staged
    monkeypatch.setattr(T, "staged", lambda df, name: names.append(name) or real(df, name))
    store = HistoryStore(spark, os.path.join(tmpdir_path, "h"), key="k", buckets=4)
    snapshot = lambda at: lambda cur, src: snapshot_check(cur, src, "k", ["v"], at)
    for at, rows in (("2024-01-01 00:00:00", "1 a,2 b"), ("2024-01-02 00:00:00", "1 A,3 c")):
        src = spark.createDataFrame([tuple(r.split()) for r in rows.split(",")], "k string, v string")
        store.publish(src, at, snapshot(at))
    assert names == ["history-source", "history-result"] * 2
    versions = lambda: sorted((r.k, r.v, r.valid_to is None) for r in store.read().collect())
    want = [("1", "A", True), ("1", "a", False), ("2", "b", True), ("3", "c", True)]
    assert versions() == want
    before = store.read(hidden=True)
    names.clear()
    store.rebuild(before)
    assert names == ["history-rebuilt"] and versions() == want
