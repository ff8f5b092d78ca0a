"""Quality, freshness and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicflow.operators.freshness import freshness
from civicflow.operators.profile import file_profile, run_summary
from civicflow.plans import checks as C
from civicflow.plans.marts import daily_summary
from civicflow.sources.seeds import load_seed
from civicflow.sources.service_requests import AS_OF

FRESHNESS_PROBES = ("2024-01-31 00:00:00", "2024-02-01 12:00:00", "2024-02-05 00:00:00")


def _gold(spark, sf_dir):
    from civicflow.catalog.queries import gold
    return gold(spark, sf_dir)


def _bronze(spark, sf_dir):
    from civicflow.catalog.queries import _prepare, sr_bronze
    _prepare(spark)
    return sr_bronze(spark, sf_dir)


def q_source_checks(spark, sf_dir):
    return C.suite(_bronze(spark, sf_dir), C.source_checks(), "bronze")


def q_staging_checks(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return C.suite(g.clean, C.staging_checks(), "requests_clean")


def q_enriched_checks(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return C.suite(g.enriched, C.enriched_checks(), "requests_enriched")


def q_core_checks(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return (C.suite(g.dim_b, C.dim_borough_checks(), "dim_borough")
            .unionByName(C.suite(g.dim_t, C.dim_type_checks(), "dim_request_type"))
            .unionByName(C.suite(g.fact, C.fact_checks(g.dim_b, g.dim_t, g.enriched), "fact_requests")))


def q_mart_checks(spark, sf_dir):
    g = _gold(spark, sf_dir)
    mart = daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF)
    return C.suite(mart, C.mart_checks(), "daily_summary")


def q_seed_checks(spark, sf_dir):
    """Seed checks, plus coverage of the observed silver domains by the seeds
    (warn: an observed value without metadata means the seed needs a row)."""
    from civicflow.catalog.queries import _prepare, sr_bronze
    from civicflow.plans.staging import base, clean
    _prepare(spark)
    sb, st = load_seed(spark, "borough_lookup"), load_seed(spark, "complaint_type_lookup")
    silver = clean(base(sr_bronze(spark, sf_dir)))
    return (C.suite(sb, C.borough_seed_checks(), "borough_lookup")
            .unionByName(C.suite(st, C.type_seed_checks(), "complaint_type_lookup"))
            .unionByName(C.suite(silver, C.seed_coverage_checks(sb, st), "requests_clean")))


def q_order_relationship_checks(spark, sf_dir):
    """Q2 + Q4 on driver tables: order keys unique, every order's customer exists."""
    from civicflow.catalog.queries import table
    from civicflow.operators import quality as q
    orders, cust = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return C.suite(orders, [q.unique("o_orderkey"), q.not_null("o_custkey"),
                            q.relationships("o_custkey", cust, "c_custkey"),
                            q.accepted_values("o_orderstatus", ("F", "O", "P"))], "orders")


def q_failing_checks(spark, sf_dir):
    """Q1-Q7 on rules that the order lines break: every kind of check reports failures."""
    from civicflow.catalog.queries import table
    from civicflow.operators import quality as q
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").withColumn("late_line", F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")))
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    return C.suite(lines, [q.not_null("late_line"), q.unique("l_orderkey"), q.accepted_values("l_returnflag", ("A", "N")),
                           q.expression_is_true("< 40", "l_quantity"), q.relationships("l_orderkey", urgent, "o_orderkey"),
                           q.unique_combination(("l_orderkey", "l_linenumber")), q.equal_rowcount(orders, severity="warn")], "lineitem")


def q_events_freshness(spark, sf_dir):
    """Q8: newest event time against three probe times (pass / warn / error)."""
    from civicflow.catalog.queries import table
    ev = table(spark, sf_dir, "events")
    out = None
    for t in FRESHNESS_PROBES:
        r = freshness(ev, "ts", t).select(F.lit(t).cast("timestamp_ntz").alias("as_of"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def q_file_profile(spark, sf_dir):
    """Q10: per landed file quality profile of the SR bronze rows."""
    return file_profile(_bronze(spark, sf_dir))


def q_run_summary(spark, sf_dir):
    """Q11: run totals of the per-file profile."""
    return run_summary(file_profile(_bronze(spark, sf_dir)))


def q_contract_report(spark, sf_dir):
    """Q9: contract conformance of the four gold products."""
    from civicflow.operators.contracts import CONTRACTS, contract_report
    g = _gold(spark, sf_dir)
    mart = daily_summary(g.fact, g.dim_b, g.dim_t, AS_OF)
    # A product that drifted: a column of another type, one too many, one missing, and NULLs where none may be.
    drifted = (g.dim_b.withColumn("area_sq_mi", F.col("area_sq_mi").cast("double")).withColumn("note", F.lit("x")).drop("county_name")
               .withColumn("is_missing_metadata", F.when(F.col("borough_name") != "Queens", F.col("is_missing_metadata"))))
    parts = [contract_report(drifted, CONTRACTS["dim_borough"], "dim_borough (drifted)"),
             contract_report(g.dim_b, CONTRACTS["dim_borough"], "dim_borough"),
             contract_report(g.dim_t, CONTRACTS["dim_request_type"], "dim_request_type"),
             contract_report(g.fact, CONTRACTS["fact_requests"], "fact_requests"),
             contract_report(mart, CONTRACTS["daily_summary"], "daily_summary")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def extra() -> dict:
    return {
        "q_source_checks": q_source_checks,
        "q_staging_checks": q_staging_checks,
        "q_enriched_checks": q_enriched_checks,
        "q_core_checks": q_core_checks,
        "q_mart_checks": q_mart_checks,
        "q_seed_checks": q_seed_checks,
        "q_order_relationship_checks": q_order_relationship_checks,
        "q_failing_checks": q_failing_checks,
        "q9_contract_report": q_contract_report,
        "q8_events_freshness": q_events_freshness,
        "q10_file_profile": q_file_profile,
        "q11_run_summary": q_run_summary,
    }
