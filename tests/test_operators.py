"""Operators on hand rows: dedup, lookups, merge, history, checks, contracts."""

import pytest
from pyspark.sql import functions as F

from civicflow.operators import quality as q
from civicflow.operators.contracts import CONTRACTS, apply_contract, contract_drift
from civicflow.operators.dedup import latest_per_key
from civicflow.operators.history import as_of, snapshot_check
from civicflow.operators.incremental import merge_upsert, since
from civicflow.operators.lookup import resolve_fk


def test_latest_per_key_null_placement_and_tiebreak(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "b", 2), ("k", "a", 3), ("j", "x", 1), ("j", "x", 2)],
                               "k string, f string, t int")
    first = latest_per_key(df, ["k"], [F.col("f").desc_nulls_first()], [F.col("t").desc()])
    last = latest_per_key(df, ["k"], [F.col("f").desc_nulls_last()], [F.col("t").desc()])
    assert sorted(tuple(r) for r in first.collect()) == [("j", "x", 2), ("k", None, 1)]
    assert sorted(tuple(r) for r in last.collect()) == [("j", "x", 2), ("k", "b", 2)]


def test_dedup_plan_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], [F.col("v").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_resolve_fk_routes_missing_and_null_to_sentinel(spark):
    dim = spark.createDataFrame([("sk_a", "A"), ("sk_u", "Unknown")], "sk string, name string")
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, name string")
    got = sorted(tuple(r) for r in resolve_fk(fact, dim, "name", "name", "sk", "Unknown")
                 .select("id", "sk").collect())
    assert got == [(1, "sk_a"), (2, "sk_u"), (3, "sk_u")]


def test_resolve_fk_fails_on_duplicate_sentinel(spark):
    dim = spark.createDataFrame([("s1", "Unknown"), ("s2", "Unknown")], "sk string, name string")
    fact = spark.createDataFrame([(1, "B")], "id int, name string")
    with pytest.raises(Exception):
        resolve_fk(fact, dim, "name", "name", "sk", "Unknown").collect()


def test_merge_upsert_replaces_inserts_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    once = merge_upsert(target, src, ["id"])
    twice = merge_upsert(once, src, ["id"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_since_high_water_mark_and_first_run(spark):
    rows = [(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-03 00:00:00")]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    target = df.filter("id <= 2")
    assert [r.id for r in since(df, target, "t").collect()] == [3]
    assert since(df, None, "t").count() == 3
    assert since(df, target, "t", full_refresh=True).count() == 3
    empty = df.filter("false")
    assert since(df, empty, "t").count() == 3


def test_snapshot_history_invariants(spark):
    g1 = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, s string")
    g2 = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, s string")
    g3 = spark.createDataFrame([(2, None), (4, "d")], "k int, s string")
    h = snapshot_check(None, g1, "k", ["s"], "2024-01-01 00:00:00")
    h = snapshot_check(h, g2, "k", ["s"], "2024-01-02 00:00:00")
    h = snapshot_check(h, g3, "k", ["s"], "2024-01-03 00:00:00")
    rows = h.collect()
    open_per_key = {}
    for r in rows:
        if r.valid_to is None:
            open_per_key[r.k] = open_per_key.get(r.k, 0) + 1
    assert open_per_key == {1: 1, 2: 1, 3: 1, 4: 1}  # missing keys stay open
    versions_2 = sorted((r.valid_from, r.valid_to, r.s) for r in rows if r.k == 2)
    assert [v[2] for v in versions_2] == ["b", "B", None]  # NULL-safe change detection
    for (a0, a1, _), (b0, _, _) in zip(versions_2, versions_2[1:]):
        assert a1 == b0  # no gaps, no overlaps
    current = as_of(h, "2024-01-02 12:00:00").filter("k = 2").collect()
    assert [r.s for r in current] == ["B"]


def test_checks_fused_results(spark):
    df = spark.createDataFrame([(1, "x", 5), (1, None, -1), (2, "y", None)], "id int, v string, n int")
    parent = spark.createDataFrame([(1,)], "id int")
    checks = [q.not_null("v"), q.unique("id"), q.accepted_values("v", ["x"], severity="warn"),
              q.expression_is_true(">= 0", "n"), q.relationships("id", parent, "id"),
              q.unique_combination(("id", "v")), q.equal_rowcount(parent)]
    got = {(r.check, r.column): (r.severity, r.failures) for r in q.run_checks(df, checks).collect()}
    assert got[("not_null", "v")] == ("error", 1)
    assert got[("unique", "id")] == ("error", 1)
    assert got[("accepted_values", "v")] == ("warn", 1)
    assert got[("expression_is_true", "n")] == ("error", 1)  # NULL passes
    assert got[("relationships", "id")] == ("error", 1)
    assert got[("unique_combination", "id,v")] == ("error", 0)
    assert got[("equal_rowcount", None)] == ("error", 2)
    with pytest.raises(q.CheckFailed):
        q.enforce(q.run_checks(df, [q.not_null("v")]))
    assert q.enforce(q.run_checks(df, [q.accepted_values("v", ["x"], severity="warn")]))


def test_contract_casts_and_enforces_not_null(spark):
    c = CONTRACTS["dim_request_type"]
    ok = spark.createDataFrame([("sk", "T", "Other", False, False, False, "2024-01-01 00:00:00")],
                               ", ".join(f"{n} string" if i in (0, 1, 2, 6) else f"{n} boolean"
                                         for i, n in enumerate(c.columns)))
    out = apply_contract(ok, c)
    assert contract_drift(out, c) == []
    assert out.schema["dim_loaded_at"].dataType.simpleString() == "timestamp_ntz"
    bad = ok.withColumn("category", F.lit(None).cast("string"))
    with pytest.raises(Exception):
        apply_contract(bad, c).collect()
    with pytest.raises(ValueError):
        apply_contract(ok.drop("category"), c)


def test_contract_rejects_extra_columns(spark):
    c = CONTRACTS["dim_request_type"]
    df = spark.createDataFrame([("sk", "T", "Other", False, False, False, "2024-01-01 00:00:00", 1)],
                               ", ".join(f"{n} string" if i in (0, 1, 2, 6) else f"{n} boolean" for i, n in enumerate(c.columns)) + ", note int")
    with pytest.raises(ValueError, match="unexpected columns"):
        apply_contract(df, c)


def test_merge_upsert_raises_on_a_duplicated_source_key(spark):
    target = spark.createDataFrame([(1, "a")], "id int, v string")
    src = spark.createDataFrame([(2, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, v string")
    with pytest.raises(Exception, match="duplicate source key"):
        merge_upsert(target, src, ["id"]).collect()
    assert merge_upsert(target, src.where("v != 'c'"), ["id"]).count() == 4  # NULL keys match nothing


def test_numbering_and_exact_percentiles(spark):
    import random

    from civicflow.operators.ranking import exact_percentiles, numbered
    rng = random.Random(2)
    rows = [(rng.choice("aab") if i % 50 else None, rng.choice([rng.random(), 0.5, None])) for i in range(2000)] + [("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = [r["rank"] for r in numbered(df.where("v is not null"), [F.col("v").desc(), F.col("g").asc()]).orderBy(F.desc("v"), "g").collect()]
    assert sorted(got) == list(range(1, len(got) + 1))
    found = {r.g: (r.p50, r.p90) for r in exact_percentiles(df, "g", "v", {"p50": 0.5, "p90": 0.9}).collect()}
    want = {r.g: (r.p50, r.p90) for r in df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.9)).alias("p90")).collect()}
    assert set(found) == set(want)
    assert all(found[g] == pytest.approx(want[g]) for g in want)
