"""Shared pieces: reading tables, scratch tables, and bounded slices of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.session import scratch_path

# Texts are tokenised in slices of about this many bytes, so a task's working
# set does not depend on how long documents are or how many share a batch.
SLICE_BYTES = 1 << 20


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so their Python workers can import it
    wherever the driver was started (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="civicflow-py-")) / "civicflow.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors and gives later joins a known size.

    The written files replace the shuffles that led to them, so Spark is told (once per session) to drop shuffles
    at the end of a query instead of when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if spark.conf.get(DROP_SHUFFLES, "false") != "true":
        spark.conf.set(DROP_SHUFFLES, "true")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(total_units: int, units_per_bucket: int, spark: SparkSession) -> int:
    """How many hash buckets keep each near ``units_per_bucket``; at least the session's shuffle width."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-int(total_units) // units_per_bucket), 1)


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows.join(lookup, key, how)`` for stored ``rows`` and a lookup with a row per key, without a hot task.

    A key is hot if it has more than a shuffle partition's share of the rows, so there are fewer hot keys
    than partitions: a proven bound, under which their part of the lookup is broadcast.  All others shuffle.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = rows.count()
    hot = stored(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") * width > total).select(key), "hot-keys")
    if hot.isEmpty():
        return rows.join(lookup, key, how)
    small = F.broadcast(stored(lookup.join(F.broadcast(hot), key, "left_semi"), "hot-lookup"))
    spread = rows.join(F.broadcast(hot), key, "left_semi").join(small, key, how)
    return spread.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(lookup, key, how))


def text_bytes(docs: DataFrame, col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(col))).first()[0] or 0


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying the text; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    if data is None or not off[-1]:
        return np.zeros(0, np.uint8), off - off[0]
    flat = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return flat, off - off[0]


def slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` bytes of ``col`` (one row at least)."""
    if not batch.num_rows:
        return
    _, off = byte_view(batch.column(col))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
