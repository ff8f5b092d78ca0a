"""One whole run - bronze -> silver -> dims -> fact -> mart -> history, with the checks
of each layer.  A run reads bronze loaded since the last one, replaces the partitions it
touches, and evaluates each source once per write.

Every product is written aside, checked, and only then published and entered in the run ledger with the
mark of its input.  A run that a check stops leaves that product and its mark as they were, so the next run
looks at the same rows again: it stops again, or, once a corrected load has arrived, gives what one clean run would.
"""

from __future__ import annotations

import datetime
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators import quality as q
from civicflow.operators.freshness import freshness
from civicflow.plans import checks as C
from civicflow.plans.enriched import enrich
from civicflow.plans.history import history_input, newer_than_seen, rebuilt_history, snapshot_requests
from civicflow.plans.marts import daily_summary
from civicflow.plans.staging import base, cleaned_rows, latest_versions
from civicflow.plans.star import dim_borough, dim_request_type, fact_increment
from civicflow.sources import tables as T
from civicflow.sources.ledger import STARTED, STOPPED, Entry, RunLedger
from civicflow.sources.seeds import load_seed

SILVER_PART = "_created_month"
MART_PART = "_month"


class Warehouse:
    """Layered product folders under one root (S10 routing: custom layer names verbatim)."""

    def __init__(self, spark: SparkSession, root: str, layers: dict[str, str | None] | None = None):
        self.spark = spark
        self.root = root
        layers = layers or {}
        self.layer = {k: T.layer_name(layers.get(k), k) for k in ("bronze", "silver", "gold")}

    def path(self, layer: str, name: str) -> str:
        return os.path.join(self.root, self.layer[layer], name)

    def read(self, layer: str, name: str) -> DataFrame | None:
        p = self.path(layer, name)
        return T.read_table(self.spark, p) if T.table_exists(self.spark, p) else None

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        T.write_table(df, self.path(layer, name))
        return T.read_table(self.spark, self.path(layer, name))

    def silver_latest_table(self) -> T.PartitionedTable:
        return T.PartitionedTable(self.spark, self.path("silver", "requests_latest"), SILVER_PART, mark_col="extracted_at")

    def observed_table(self) -> T.PartitionedTable:
        """The natural keys that clean silver holds, with their numbers, by silver's partitions: (kind, value, n)."""
        return T.PartitionedTable(self.spark, self.path("silver", "observed_values"), SILVER_PART)

    def mart_table(self) -> T.PartitionedTable:
        return T.PartitionedTable(self.spark, self.path("gold", "daily_summary"), MART_PART)

    def history_store(self) -> T.HistoryStore:
        return T.HistoryStore(self.spark, self.path("silver", "request_history"))

    def fact_table(self) -> T.PartitionedTable:
        return T.PartitionedTable(self.spark, self.path("gold", "fact_requests"), "created_month", mark_col="extracted_at")

    def ledger(self) -> RunLedger:
        return RunLedger(self.spark, os.path.join(self.root, "run_ledger"))

    @property
    def bronze_dir(self) -> str:
        return self.path("bronze", "requests_raw")

    def bronze(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.bronze_dir)


def since_mark(bronze: DataFrame, mark: str | None) -> DataFrame:
    """Bronze loaded at or after a mark.  Rows at the mark are read again, so a load that shares
    its stamp is never missed; every merge is idempotent."""
    return bronze if mark is None else bronze.filter(F.col("_extracted_at") >= F.lit(mark).cast("timestamp_ntz"))


def silver_change(wh: Warehouse, new_bronze: DataFrame, full_refresh: bool = False) -> T.Change:
    """P2 maintained incrementally: the newest cleaned version of every id, before the created_at filter,
    so an id whose newest version lacks a date still disappears, as in a full recompute."""
    table = wh.silver_latest_table()
    rows = cleaned_rows(base(new_bronze)).withColumn(SILVER_PART, F.trunc(F.to_date("created_at"), "month"))
    return table.prepare_overwrite(latest_versions(rows)) if full_refresh else table.prepare_merge_latest(rows, ["complaint_id"], latest_versions)


def clean_silver(latest: DataFrame) -> DataFrame:
    return latest.filter(F.col("created_at").isNotNull()).drop(SILVER_PART)


def build_silver(wh: Warehouse, new_bronze: DataFrame, full_refresh: bool = False) -> DataFrame:
    """P2 merged and published at once."""
    silver_change(wh, new_bronze, full_refresh).publish()
    return clean_silver(wh.silver_latest_table().read())


NATURAL_KEYS = ("borough", "complaint_type")


def _observed(latest: DataFrame) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in NATURAL_KEYS]))
    return (latest.filter(F.col("created_at").isNotNull()).select(SILVER_PART, each.alias("k")).where("k.value is not null")
            .groupBy("k.kind", "k.value", SILVER_PART).agg(F.count("*").alias("n")).select("kind", "value", "n", SILVER_PART))


def refresh_observed(wh: Warehouse, change: T.Change) -> dict[str, DataFrame]:
    """Keep the observed values in step with a change of silver: counts of the partitions it replaced are made anew, so a
    value whose last request moved away is gone, and a repeated run changes nothing.  Returns a DataFrame of each key's values."""
    table = wh.observed_table()
    if change.whole or not table.exists():
        table.overwrite(_observed(wh.silver_latest_table().read()))
    elif change.rows is not None:
        table.prepare_replace(_observed(change.changed()), change.values).publish()
    held = table.read()
    if held is None:
        held = wh.spark.createDataFrame([], "kind string, value string")
    return {c: held.where(F.col("kind") == c).select(F.col("value").alias(c)) for c in NATURAL_KEYS}


def _dates(spelled: list[str]) -> list[datetime.date | None]:
    """Partition values as the ledger spells them."""
    return [None if d == "None" else datetime.date.fromisoformat(d) for d in spelled]


def staged_dim(wh: Warehouse, name: str, dim: DataFrame) -> tuple[DataFrame, bool]:
    """A dimension written aside, and whether its content differs from the published one (load stamps aside)."""
    new, old = T.staged(dim, name), wh.read("gold", name)
    content = lambda df: df.drop("dim_loaded_at")
    if old is not None and content(new).exceptAll(content(old)).isEmpty() and content(old).exceptAll(content(new)).isEmpty():
        return old, False
    return new, True


def refresh_dim(wh: Warehouse, name: str, dim: DataFrame) -> tuple[DataFrame, bool]:
    """Write a dimension if its content changed; returns it and whether it did."""
    new, changed = staged_dim(wh, name, dim)
    return (wh.write("gold", name, new) if changed else new), changed


# Columns of the fact that depend on when a row was merged.
MERGE_TIME_COLUMNS = ("days_since_created", "complaint_age_bucket", "fct_loaded_at")


def without_merged(inc: DataFrame, fact: DataFrame | None, mark: str | None) -> DataFrame:
    """``inc`` without the rows stamped exactly at the mark that the fact holds already: such rows are read again,
    since another load may share the stamp, and only what is new in them is merged."""
    if fact is None or mark is None:
        return inc
    at_mark = F.col("extracted_at") == F.lit(mark).cast("timestamp_ntz")
    same = F.sha2(F.to_json(F.struct(*[c for c in inc.columns if c not in MERGE_TIME_COLUMNS]), {"ignoreNullFields": "false"}), 256)
    held = fact.where(at_mark).select(F.col("complaint_id").alias("__id"), same.alias("__held"))
    rows = inc.withColumn("__same", same)
    return rows.join(held, at_mark & (F.col("complaint_id") == F.col("__id")) & (F.col("__same") == F.col("__held")), "left_anti").drop("__same")


def mart_change(wh: Warehouse, fact: DataFrame, dim_b: DataFrame, dim_t: DataFrame, as_of: str,
                touched_months: list, rebuild: bool = False) -> T.Change:
    """P7 recomputed for the months whose fact rows changed (a day never spans months, so this is
    exact).  A changed dimension can move any row and rebuilds everything."""
    table = wh.mart_table()

    def summary(f):
        return daily_summary(f, dim_b, dim_t, as_of).withColumn(MART_PART, F.trunc("created_date", "month"))

    if rebuild or not table.exists():
        return table.prepare_overwrite(summary(fact))
    if touched_months:
        return table.prepare_replace(summary(fact.filter(F.col("created_month").isin(touched_months))), touched_months)
    return T.Change(table, None, [])


def refresh_mart(wh: Warehouse, fact: DataFrame, dim_b: DataFrame, dim_t: DataFrame, as_of: str,
                 touched_months: list, rebuild: bool = False) -> DataFrame:
    """P7 refreshed and published at once."""
    mart_change(wh, fact, dim_b, dim_t, as_of, touched_months, rebuild).publish()
    return wh.mart_table().read().drop(MART_PART)


def publish_history(wh: Warehouse, ledger: RunLedger, run: int, bronze: DataFrame, upto: str | None, run_at: str, full_refresh: bool) -> None:
    """P8 for what was loaded since the history's mark.  A run that was cut short while it wrote the history is
    finished first, with its own time and input, so no version is closed twice."""
    store = wh.history_store()
    if full_refresh:
        runs = ledger.runs_of("request_history")
        store.rebuild(rebuilt_history(bronze, runs.unionByName(wh.spark.createDataFrame([(run, upto, run_at)], runs.schema))))
        ledger.record(run, "request_history", mark=upto, run_at=run_at)
        return
    steps = [Entry(0, run, upto, run_at)]
    if (cut := ledger.unfinished("request_history")) is not None:
        steps.insert(0, cut)
    mark = ledger.passed().get("request_history", Entry()).mark
    for step in steps:
        ledger.record(step.run, "request_history", STARTED, step.mark, step.run_at)
        new = since_mark(bronze, mark)
        new = new if step.mark is None else new.filter(F.col("_extracted_at") <= F.lit(step.mark).cast("timestamp_ntz"))
        store.publish(history_input(new, with_filename=True), step.run_at,
                      lambda current, src, at=step.run_at: snapshot_requests(current, newer_than_seen(current, src), at))
        ledger.record(step.run, "request_history", mark=step.mark, run_at=step.run_at)
        mark = step.mark


def pending_loads(wh: Warehouse) -> list[str]:
    """Streamed batches that landed in bronze and that no finished run has built from."""
    built = set(wh.ledger().since("loads", 0))
    queries = [n for n in T.folder_names(wh.spark, wh.bronze_dir) if n.startswith("query=")]
    batches = [f"{q_}/{b}" for q_ in queries for b in T.folder_names(wh.spark, os.path.join(wh.bronze_dir, q_))]
    return [b for b in batches if b not in built and "_SUCCESS" in T.folder_names(wh.spark, os.path.join(wh.bronze_dir, b))]


def build_pending(wh: Warehouse, as_of: str, **how) -> dict[str, DataFrame] | None:
    """One run over all streamed batches not built yet, or None if there are none.

    However many micro-batches a backlog came in, the build runs once; batches are entered as built after the
    run went through, so a stopped or lost run is made again at the next call, with or without new files.
    """
    waiting = pending_loads(wh)
    if not waiting:
        return None
    out = run_all(wh, as_of, **how)
    ledger = wh.ledger()
    ledger.record(ledger.next_run() - 1, "loads", run_at=as_of, detail=waiting)
    return out


def run_all(wh: Warehouse, as_of: str, full_refresh: bool = False, history_at: str | None = None,
            on_error: str = "raise") -> dict[str, DataFrame]:
    """Build every product from the current bronze, layer by layer.

    Each layer's checks run before it is published; with ``on_error="raise"`` an ``error`` check with
    failures stops the run there, is entered in the ledger, and leaves this and all later products as they
    were.  ``"continue"`` publishes every layer and only reports.  A product reads its input from its own mark on;
    the checks of bronze and silver look at everything since the last run that went through.  Later loads that
    arrive during a run are left to the next one.  A full refresh reads all of bronze and rebuilds the history
    with its closed versions; one that a check stops has to be asked for again.  Returns the products and the check results.
    """
    spark, ledger = wh.spark, wh.ledger()
    run, passed = ledger.next_run(), {} if full_refresh else ledger.passed()
    entry = lambda product: passed.get(product, Entry())
    reports: list[DataFrame] = []

    checked_mark, silver_mark = entry("run").mark, entry("requests_latest").mark
    upto = since_mark(wh.bronze(), silver_mark).agg(F.max("_extracted_at").cast("string")).first()[0] or silver_mark
    bronze = wh.bronze() if upto is None else wh.bronze().filter(F.col("_extracted_at") <= F.lit(upto).cast("timestamp_ntz"))

    def gate(df: DataFrame, checks, table: str) -> None:
        res = T.staged(C.suite(df, checks, table), "check-results")  # a row per check, evaluated once
        reports.append(res)
        if on_error != "raise":
            return
        try:
            q.enforce(res.drop("table"))
        except q.CheckFailed as e:
            ledger.record(run, table, STOPPED, upto, as_of, [str(e)])
            raise

    # Q8: source freshness is reported but never blocks the run (warn or error alike).
    unchecked = since_mark(bronze, checked_mark)
    fresh = freshness(unchecked, "_extracted_at", as_of, known_max=checked_mark)
    gate(unchecked, C.source_checks(), "bronze")

    change = silver_change(wh, since_mark(bronze, silver_mark), full_refresh)
    recent = change.after()
    if checked_mark is not None:  # only partitions that silver changed since then can hold such rows
        since_run = [*_dates(ledger.since("requests_latest", entry("run").seq)), *change.values]
        recent = recent.where(wh.silver_latest_table().within(since_run)).filter(F.col("extracted_at") >= F.lit(checked_mark).cast("timestamp_ntz"))
    recent = clean_silver(recent)
    gate(recent, C.staging_checks(), "requests_clean")
    gate(enrich(recent, as_of), C.enriched_checks(), "requests_enriched")
    replaced = change.publish()
    observed = refresh_observed(wh, change)
    ledger.record(run, "requests_latest", mark=upto, run_at=as_of, detail=[str(v) for v in {*replaced, *change.values}])
    latest = wh.silver_latest_table()
    silver = clean_silver(latest.read())

    dims = {"dim_borough": (dim_borough(observed["borough"], load_seed(spark, "borough_lookup"), as_of), C.dim_borough_checks()),
            "dim_request_type": (dim_request_type(observed["complaint_type"], load_seed(spark, "complaint_type_lookup"), as_of), C.dim_type_checks())}
    for name, (dim, checks) in dims.items():
        new, changed = staged_dim(wh, name, dim)
        gate(new, checks, name)
        dims[name] = wh.write("gold", name, new) if changed else new
    dim_b, dim_t = dims["dim_borough"], dims["dim_request_type"]

    facts, fact_mark = wh.fact_table(), entry("fact_requests").mark
    target = None if full_refresh else facts.read()
    pending = silver
    if fact_mark is not None:
        since_fact = _dates(ledger.since("requests_latest", entry("fact_requests").seq))
        pending = clean_silver(latest.read().where(latest.within(since_fact))).filter(F.col("extracted_at") >= F.lit(fact_mark).cast("timestamp_ntz"))
    pending = enrich(pending, as_of)
    inc = without_merged(fact_increment(pending, dim_b, dim_t, as_of), target, fact_mark)
    change = facts.prepare_overwrite(inc) if target is None else facts.prepare_merge(inc, ["complaint_id"])
    rows = change.changed()
    months = change.values if not change.whole else [r[0] for r in rows.select("created_month").distinct().collect()]
    same_months = enrich(clean_silver(latest.read().where(latest.within(months))), as_of)  # silver's partitions are the fact's months
    gate(rows, C.fact_checks(dim_b, dim_t, same_months), "fact_requests")
    change.publish()
    ledger.record(run, "fact_requests", mark=upto, run_at=as_of, detail=[str(m) for m in months])
    fact = facts.read()

    # The mart follows every month that the fact changed since the mart was published last, and the dimensions it was made with.
    versions = [f"{name}/{os.path.basename(T.current_version(spark, wh.path('gold', name)))}" for name in dims]
    mart = entry("daily_summary")
    touched = _dates(ledger.since("fact_requests", mart.seq))
    change = mart_change(wh, fact, dim_b, dim_t, as_of, touched, full_refresh or sorted(mart.detail) != sorted(versions))
    gate(change.after().drop(MART_PART), C.mart_checks(), "daily_summary")
    change.publish()
    ledger.record(run, "daily_summary", mark=upto, run_at=as_of, detail=versions)

    publish_history(wh, ledger, run, bronze, upto, history_at or as_of, full_refresh)
    ledger.record(run, "run", mark=upto, run_at=as_of)
    results = reports[0]
    for r in reports[1:]:
        results = results.unionByName(r)
    return {"silver": silver, "dim_borough": dim_b, "dim_request_type": dim_t, "fact": fact,
            "daily_summary": wh.mart_table().read().drop(MART_PART), "history": wh.history_store().read(), "checks": results, "freshness": fresh}
