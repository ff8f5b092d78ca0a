"""The run ledger: which input every product holds, and which runs a gate stopped.

A small table with a row per event: (seq, run, product, status, mark, run_at, detail).  A product's mark is the
input mark of its last ``passed`` row, so it moves only after the product was checked and published; a run that
stops leaves all later marks where they were, and the next run reads the same input again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.sources.tables import current_version, drop_old_versions, write_table

SCHEMA = "seq long, run long, product string, status string, mark string, run_at string, detail array<string>"
PASSED, STARTED, STOPPED = "passed", "started", "stopped"


@dataclass(frozen=True)
class Entry:
    """The last passed row of a product; a product that never passed has all-None fields."""

    seq: int = 0
    run: int = 0
    mark: str | None = None
    run_at: str | None = None
    detail: tuple[str, ...] = ()


class RunLedger:
    """Versions of one small Parquet table; every row added is a new version, so a reader never sees half of one."""

    def __init__(self, spark: SparkSession, table_dir: str):
        self.spark, self.dir = spark, table_dir
        self._last: int | None = None  # the last row's seq, known after the first record

    def rows(self) -> DataFrame:
        path = current_version(self.spark, self.dir)
        return self.spark.createDataFrame([], SCHEMA) if path is None else self.spark.read.schema(SCHEMA).parquet(path)

    def next_run(self) -> int:
        return (self.rows().agg(F.max("run")).first()[0] or 0) + 1

    def passed(self) -> dict[str, Entry]:
        """Each product's last passed row (a row per product comes to the driver)."""
        last = (self.rows().where(F.col("status") == PASSED)
                .groupBy("product").agg(F.max_by(F.struct("seq", "run", "mark", "run_at", "detail"), "seq").alias("e")).select("product", "e.*"))
        return {r["product"]: Entry(r.seq, r.run, r.mark, r.run_at, tuple(r.detail)) for r in last.collect()}

    def unfinished(self, product: str) -> Entry | None:
        """The product's last row if it was started and did not pass."""
        last = self.rows().where(F.col("product") == product).orderBy(F.desc("seq")).limit(1).collect()
        return Entry(*[last[0][c] for c in ("seq", "run", "mark", "run_at")]) if last and last[0].status == STARTED else None

    def since(self, product: str, seq: int) -> list[str]:
        """The distinct details of a product's passed rows after ``seq``."""
        rows = self.rows().where((F.col("product") == product) & (F.col("status") == PASSED) & (F.col("seq") > seq))
        return [r[0] for r in rows.select(F.explode("detail")).distinct().collect()]

    def runs_of(self, product: str) -> DataFrame:
        """(run, mark, run_at) of all passed runs of a product, in time order by run."""
        return self.rows().where((F.col("product") == product) & (F.col("status") == PASSED)).select("run", "mark", "run_at")

    def record(self, run: int, product: str, status: str = PASSED, mark: str | None = None, run_at: str | None = None,
               detail: list[str] | tuple[str, ...] = ()) -> None:
        old = self.rows()
        self._last = 1 + (self._last if self._last is not None else old.agg(F.max("seq")).first()[0] or 0)
        new = self.spark.createDataFrame([(self._last, run, product, status, mark, run_at, list(detail))], SCHEMA)
        write_table(old.unionByName(new).coalesce(1), self.dir)  # a handful of rows per run
        drop_old_versions(self.spark, self.dir, keep=3)
