"""Continuous file ingest into bronze, with downstream runs per micro-batch.

``availableNow`` processes every file that has landed since the last run
(each file exactly once, tracked in the checkpoint) and then stops, so a
scheduler can run it like a batch job; the same code runs continuously with
a processing-time trigger.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.sources.bronze import to_bronze
from civicflow.sources.landing import records_from_text


def landing_stream(spark: SparkSession, root: str, layout: str = "array", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over the landing zone, at any folder depth: file (or line) text + file path."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.text(root, wholetext=layout == "array", recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("__path"))


def landed_files(spark: SparkSession, root: str) -> int:
    """Files of the landing zone at any folder depth, listed without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path").count()


def ingest_available(spark: SparkSession, landing_root: str, bronze_dir: str, checkpoint: str,
                     loaded_at: str | None, layout: str = "array",
                     on_batch: Callable[[DataFrame, int], None] | None = None,
                     processing_time: str | None = None, max_files_per_trigger: int | None = None,
                     max_batches: int | None = None):
    """T1 + T2: load every newly landed file into bronze, then call ``on_batch``.

    Each micro-batch is written to ``bronze_dir/query=<id>/batch=<n>`` with overwrite, so a
    retried batch replaces its own output instead of duplicating it (``foreachBatch`` is
    at-least-once), and a stream with another checkpoint never touches it.  ``max_files_per_trigger``
    splits a backlog into batches; with ``max_batches`` a batch takes more files where a backlog would
    give more batches than that, as each has a fixed cost.  Returns the number of batches run.

    With ``processing_time`` (e.g. ``"60 seconds"``) the same stream runs
    continuously and the started ``StreamingQuery`` is returned instead;
    ``loaded_at=None`` then stamps each batch with its load time.
    """
    ran: list[int] = []
    query: list = []
    started = threading.Event()

    def _batch(df: DataFrame, batch_id: int) -> None:
        started.wait()
        rows = to_bronze(records_from_text(df, landing_root, layout, path_col="__path"), loaded_at)
        rows.write.mode("overwrite").parquet(f"{bronze_dir.rstrip('/')}/query={query[0].id}/batch={batch_id}")
        ran.append(batch_id)
        if on_batch is not None:
            on_batch(df, batch_id)

    if max_files_per_trigger and max_batches:
        max_files_per_trigger = max(max_files_per_trigger, -(-landed_files(spark, landing_root) // max_batches))
    w = landing_stream(spark, landing_root, layout, max_files_per_trigger).writeStream.foreachBatch(_batch) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    query.append(w.start())
    started.set()
    if processing_time:
        return query[0]
    query[0].awaitTermination()
    return len(ran)
