"""Product sinks and layer routing (S8-S10, S12-S14) on plain Parquet folders.

* A full-refresh product is a series of version folders (``v=000001`` ...); Spark marks a
  finished write with ``_SUCCESS``, and readers take the highest finished version, so a
  failed run leaves the last one readable and a product can be read while it is replaced.
* A partitioned product is one folder, changed by Spark's dynamic partition overwrite:
  only the partitions that a run writes are replaced.
* What is written is first staged in the scratch folder.  Partition values and marks are read
  from the staged files, so a source is evaluated once per write.

One writer per product at a time is assumed, as for any plain Parquet folder.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.operators.incremental import unique_source
from civicflow.session import scratch_path

_VERSION = re.compile(r"^v=(\d{6,})$")


def layer_name(custom: str | None, default: str) -> str:
    """A custom layer name is used verbatim (trimmed), else the default."""
    return default if custom is None else custom.strip()


def layer_path(root: str, layer: str | None, name: str, default_layer: str = "default") -> str:
    return os.path.join(root, layer_name(layer, default_layer), name)


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _versions(spark: SparkSession, table_dir: str) -> list[int]:
    return [int(m[1]) for m in map(_VERSION.match, folder_names(spark, table_dir)) if m]


def current_version(spark: SparkSession, table_dir: str) -> str | None:
    """Folder of the newest finished version, or None if there is none."""
    for n in sorted(_versions(spark, table_dir), reverse=True):
        path = os.path.join(table_dir, f"v={n:06d}")
        if "_SUCCESS" in folder_names(spark, path):
            return path
    return None


def table_exists(spark: SparkSession, table_dir: str) -> bool:
    return current_version(spark, table_dir) is not None


def read_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """Read the current version of a table."""
    path = current_version(spark, table_dir)
    if path is None:
        raise FileNotFoundError(f"no table at {table_dir}")
    return spark.read.parquet(path)


def write_table(df: DataFrame, table_dir: str) -> str:
    """Full-refresh write of the next version; two writers of the same version: the second fails."""
    n = max(_versions(df.sparkSession, table_dir), default=0) + 1
    path = os.path.join(table_dir, f"v={n:06d}")
    df.write.mode("errorifexists").parquet(path)
    return path


def drop_old_versions(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Maintenance: delete all but the newest ``keep`` versions (readers of an older one must be done)."""
    old = sorted(_versions(spark, table_dir))[:-keep] if keep else []
    for n in old:
        fs, p = _hadoop(spark, os.path.join(table_dir, f"v={n:06d}"))
        fs.delete(p, True)
    return [f"v={n:06d}" for n in old]


def view(df: DataFrame, name: str) -> DataFrame:
    """A view product: a lazy DataFrame registered for SQL, recomputed on read."""
    df.createOrReplaceTempView(name)
    return df


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Change:
    """A staged change of a partitioned table: written aside, not yet visible.  ``after`` is the table as it
    will be, for checks; ``publish`` replaces the partitions and returns their values."""

    table: PartitionedTable
    rows: DataFrame | None          # None: nothing to change
    values: list                    # partition values that the change replaces
    whole: bool = False             # replaces the table, whatever it holds

    def after(self) -> DataFrame | None:
        current = None if self.whole else self.table.read()
        if self.rows is None or current is None:
            return current if self.rows is None else self.rows
        return current.where(~self.table.within(self.values)).unionByName(self.rows, allowMissingColumns=True)

    def changed(self) -> DataFrame:
        """The rows of the partitions that the change replaces, as they will be."""
        return self.table.read().limit(0) if self.rows is None else self.rows

    def publish(self) -> list:
        if self.rows is None:
            return []
        gone = self.values
        if self.whole and (old := self.table.read()) is not None:
            gone = [r[0] for r in old.select(self.table.col).distinct().collect()]
        written = self.table._replace(self.rows, gone)
        return written if self.whole else self.values  # a partition that the change emptied counts as replaced


class PartitionedTable:
    """A Parquet folder partitioned by one column, whose merges replace only the partitions
    that hold an old or a new version of a merged key.

    Every change can be prepared first (``prepare_*``, a ``Change``), checked, and then published.
    """

    def __init__(self, spark: SparkSession, table_dir: str, partition_col: str, mark_col: str | None = None):
        self.spark, self.dir, self.col, self.mark_col = spark, table_dir, partition_col, mark_col

    def exists(self) -> bool:
        return any(n.startswith(f"{self.col}=") for n in folder_names(self.spark, self.dir))

    def read(self) -> DataFrame | None:
        """The whole table, or None; the partition column is the last one.  Columns that a later merge
        appended are NULL in older files."""
        return self.spark.read.option("mergeSchema", "true").parquet(self.dir) if self.exists() else None

    def mark(self) -> str | None:
        """High-water mark: the largest ``mark_col`` stored (one column is read); None for no table."""
        table = self.read()
        return None if table is None else table.agg(F.max(self.mark_col).cast("string")).first()[0]

    def within(self, values: list) -> Column:
        """Whether a row is in one of the partitions; never NULL."""
        known = [v for v in values if v is not None]
        hit = F.coalesce(F.col(self.col).isin(known), F.lit(False)) if known else F.lit(False)
        return hit | F.col(self.col).isNull() if None in values else hit

    def _folder(self, value) -> str:
        """A partition's folder as Spark's writer names it."""
        if value is None:
            return f"{self.col}=__HIVE_DEFAULT_PARTITION__"
        text = self.spark.range(1).select(F.lit(value).cast("string")).first()[0]
        return f"{self.col}=" + self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(text)

    def _replace(self, rows: DataFrame, drop: list = ()) -> list:
        """Replace the partitions of staged ``rows``, and remove those of ``drop`` that got none.

        Rebalanced by partition value, so each month is a few files however many tasks wrote it.
        """
        values = [r[0] for r in rows.select(self.col).distinct().collect()]  # one per partition
        if values:
            (rows.hint("rebalance", self.col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.col).parquet(self.dir))
        for v in set(drop) - set(values):
            fs, p = _hadoop(self.spark, os.path.join(self.dir, self._folder(v)))
            fs.delete(p, True)
        return values

    def prepare_overwrite(self, df: DataFrame) -> Change:
        """Replace the whole table."""
        return Change(self, staged(df, "table-rows"), [], whole=True)

    def prepare_replace(self, df: DataFrame, values: list) -> Change:
        """Replace exactly the partitions ``values`` with ``df`` (rows of those partitions)."""
        return Change(self, staged(df, "table-rows"), values)

    def _touched(self, current: DataFrame, src: DataFrame, keys: list[str]) -> tuple[list, DataFrame]:
        """Partition values that hold an old or a new version of a key of ``src``, and their stored rows."""
        hit = current.join(src.select(*keys).distinct(), keys, "left_semi").select(self.col)
        values = [r[0] for r in src.select(self.col).unionByName(hit).distinct().collect()]
        return values, current.where(self.within(values))

    def prepare_merge(self, src: DataFrame, keys: list[str]) -> Change:
        """Matched keys replaced, new keys inserted; a key twice in the source raises.  Columns new in
        the source are appended (I3)."""
        new = staged(unique_source(src, keys), "merge-source")
        current = self.read()
        if current is None:
            return Change(self, new, [], whole=True)
        values, affected = self._touched(current, new, keys)
        if not values:
            return Change(self, None, [])
        kept = affected.join(new.select(*keys), keys, "left_anti").select(*current.columns)
        columns = current.columns + [c for c in new.columns if c not in current.columns]
        return self.prepare_replace(kept.unionByName(new, allowMissingColumns=True).select(*columns), values)

    def prepare_merge_latest(self, src: DataFrame, keys: list[str], pick) -> Change:
        """Keep, per key, the winner of ``pick`` over the stored rows and ``src`` together: the winner that a
        full recompute over all inputs would choose, whatever order they arrive in."""
        new = staged(pick(src), "merge-source")
        current = self.read()
        if current is None:
            return Change(self, new, [], whole=True)
        values, affected = self._touched(current, new, keys)
        if not values:
            return Change(self, None, [])
        both = pick(affected.unionByName(new.select(*current.columns)))
        return self.prepare_replace(both.select(*current.columns), values)

    def overwrite(self, df: DataFrame) -> list:
        return self.prepare_overwrite(df).publish()

    def replace(self, df: DataFrame, values: list, written: bool = False) -> None:
        """Replace at once; rows that are ``written`` aside already are not staged again."""
        (Change(self, df, values) if written else self.prepare_replace(df, values)).publish()

    def merge(self, src: DataFrame, keys: list[str]) -> list:
        """Merge at once; returns the partition values rewritten."""
        return self.prepare_merge(src, keys).publish()

    def merge_latest(self, src: DataFrame, keys: list[str], pick) -> list:
        return self.prepare_merge_latest(src, keys, pick).publish()


class HistoryStore:
    """Type-2 history in two folders.

    ``closed/run=<time>``: versions a run closed; never touched by a run of another time, and a repeated
    run adds nothing twice.  ``open``: one row per key, spread over key-hash buckets; a run
    replaces only the buckets of the keys it has seen.

    A rebuild writes both folders of a new generation ``g=<n>`` and marks it ready last; until then the old one
    is read, and it is never deleted here.
    """

    BUCKET = "_bucket"
    _GENERATION = re.compile(r"^g=(\d{6,})$")

    def __init__(self, spark: SparkSession, table_dir: str, key: str = "complaint_id", buckets: int = 64):
        self.spark, self.root, self.key, self.buckets = spark, table_dir, key, buckets

    def _generations(self) -> list[int]:
        return sorted(int(m[1]) for m in map(self._GENERATION.match, folder_names(self.spark, self.root)) if m)

    @property
    def dir(self) -> str:
        """The folder of the newest finished generation; the first one is the root itself."""
        for n in reversed(self._generations()):
            path = os.path.join(self.root, f"g={n:06d}")
            if "_SUCCESS" in folder_names(self.spark, os.path.join(path, "ready")):
                return path
        return self.root

    @property
    def open(self) -> PartitionedTable:
        return PartitionedTable(self.spark, os.path.join(self.dir, "open"), self.BUCKET)

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("int")

    def current(self) -> DataFrame | None:
        rows = self.open.read()
        return None if rows is None else rows.drop(self.BUCKET)

    def read(self, hidden: bool = False) -> DataFrame | None:
        """All versions; bookkeeping columns (leading ``_``) are dropped unless ``hidden``."""
        rows = self.current()
        if rows is None:
            return None
        closed = os.path.join(self.dir, "closed")
        if folder_names(self.spark, closed):
            rows = rows.unionByName(self.spark.read.option("recursiveFileLookup", "true").parquet(closed).select(*rows.columns))
        return rows if hidden else rows.select(*[c for c in rows.columns if not c.startswith("_")])

    def publish(self, source: DataFrame, run_at: str, snapshot) -> None:
        """One run: ``snapshot(open versions, source)`` gives the open versions after the run and those it
        closed.  Only open versions in the source's buckets are read and replaced."""
        new = staged(source, "history-source")
        touched = [r[0] for r in new.select(self.bucket()).distinct().collect()]  # at most ``buckets``
        rows = self.open.read()
        current = None if rows is None else rows.where(F.col(self.BUCKET).isin(touched)).drop(self.BUCKET)
        result = staged(snapshot(current, new).withColumn(self.BUCKET, self.bucket()), "history-result")
        closed = result.where("valid_to is not null").drop(self.BUCKET)
        path = os.path.join(self.dir, "closed", "run=" + re.sub(r"[^0-9A-Za-z]", "-", run_at))
        if folder_names(self.spark, path):  # this run was made before, perhaps up to here only
            closed = staged(closed.unionByName(self.spark.read.parquet(path)).dropDuplicates(["scd_id"]), "history-closed")
        closed.write.mode("overwrite").parquet(path)
        self.open.replace(result.where("valid_to is null"), touched, True)

    def rebuild(self, versions: DataFrame) -> None:
        """Replace the whole history by ``versions``, closed ones included."""
        rows = staged(versions.withColumn(self.BUCKET, self.bucket()), "history-rebuilt")
        path = os.path.join(self.root, f"g={max(self._generations(), default=0) + 1:06d}")
        rows.where("valid_to is not null").drop(self.BUCKET).write.parquet(os.path.join(path, "closed", "rebuilt"))
        PartitionedTable(self.spark, os.path.join(path, "open"), self.BUCKET).replace(rows.where("valid_to is null"), [], True)
        self.spark.range(1).write.parquet(os.path.join(path, "ready"))

    def drop_old_generations(self) -> list[str]:
        """Maintenance: delete what the newest finished generation replaced (readers of it must be done)."""
        newest = os.path.basename(self.dir)
        if self.dir == self.root:
            return []
        old = [n for n in folder_names(self.spark, self.root) if n in ("open", "closed") or n.startswith("g=") and n < newest]
        for n in old:
            fs, p = _hadoop(self.spark, os.path.join(self.root, n))
            fs.delete(p, True)
        return old
