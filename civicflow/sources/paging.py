"""Ordered page scan (newest first), page numbering for all pages, and seeks to deep pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicflow.fixed_values import PAGE_SIZE
from civicflow.operators.ranking import numbered, sorted_and_stored
from civicflow.session import scratch_path


def page(df: DataFrame, order_col: str, key_col: str, limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """One page ``ORDER BY order_col DESC, key_col LIMIT limit OFFSET offset``.

    Planned as a TakeOrderedAndProject: each task keeps its top ``offset + limit``
    rows.  For the first pages; ``paged`` numbers all of them, and ``PageIndex`` seeks.
    """
    return df.orderBy(F.col(order_col).desc(), F.col(key_col).asc()).offset(offset).limit(limit)


def paged(df: DataFrame, order_col: str, key_col: str, page_size: int = PAGE_SIZE, max_records: int | None = None) -> DataFrame:
    """All pages in one job: every row with its ``rank`` and ``batch_offset`` (0, 1000, ...).

    ``max_records`` keeps the newest rows only, if the caller asks for it.
    """
    ranked = numbered(df, [F.col(order_col).desc(), F.col(key_col).asc()])
    out = ranked.withColumn("batch_offset", F.floor((F.col("rank") - 1) / page_size).cast("long") * page_size)
    return out if max_records is None else out.where(F.col("rank") <= max_records)


class PageIndex:
    """Pages at any offset of a table that is sorted once.

    The sorted rows lie in a folder per partition of the sort; the index is one row per folder with the number of
    rows before it.  A page is read from the folders that it overlaps, one or two unless it is longer than a
    partition, however deep it lies.
    """

    def __init__(self, df: DataFrame, order_col: str, key_col: str, partitions: int | None = None):
        self.spark, self.columns = df.sparkSession, df.columns
        order = [F.col(order_col).desc(), F.col(key_col).asc()]
        self.rows = sorted_and_stored(df, order, "pages", partitions, folders=True)
        counts = self.rows.groupBy("__part").agg(F.count("*").alias("n"))  # a row per partition of the sort
        before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        path = scratch_path(self.spark, "page-index")
        counts.select("__part", "n", before.alias("before")).write.parquet(path)
        self.index = self.spark.read.parquet(path)

    def page(self, limit: int = PAGE_SIZE, offset: int = 0) -> DataFrame:
        """``limit`` rows after the first ``offset``, in order."""
        hit = self.index.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).collect()
        if not hit:
            return self.rows.select(*self.columns).limit(0)
        starts = F.create_map(*[F.lit(x) for r in hit for x in (r["__part"], r["before"])])
        rank = F.element_at(starts, F.col("__part")) + F.col("__at")
        parts = self.rows.where(F.col("__part").isin([r["__part"] for r in hit])).withColumn("__rank", rank)
        return parts.where((F.col("__rank") >= offset) & (F.col("__rank") < offset + limit)).orderBy("__rank").select(*self.columns)
