"""Row numbers over a whole table, and exact percentiles by weighted rank, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def sorted_and_stored(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None, folders: bool = False) -> DataFrame:
    """``df`` range-partitioned by ``order``, sorted where it lands and written once, with ``__part`` (the partition) and
    ``__at`` (the 0-based place in it); with ``folders``, each partition of the sort is a folder that a filter
    on ``__part`` prunes.  Rows equal in ``order`` may go to several partitions."""
    path = scratch_path(df.sparkSession, name)
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(partitions, *order, "__tie") if partitions else tied.repartitionByRange(*order, "__tie")
    placed = (ranged.sortWithinPartitions(*order, "__tie").drop("__tie").withColumn("__at", F.monotonically_increasing_id())
              .withColumn("__part", F.shiftright("__at", _ROW_BITS)).withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))))
    (placed.write.partitionBy("__part") if folders else placed.write).parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based position of each row in ``order``.

    Rows are range-partitioned and sorted where they land, and written once with their place in
    their partition; a partition's offset is the sum of the counts before it.  Rows that are equal in
    ``order`` get consecutive numbers in any order, and are spread over partitions like any others.
    """
    rows = sorted_and_stored(df, order, "numbered")
    counts = rows.groupBy("__part").agg(F.count("*").alias("__n"))
    # One row per partition of the sort, so this window is bounded by the shuffle's width.
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))
    return (rows.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__at") + 1).drop("__part", "__before", "__at"))


def exact_percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """A4 for continuous measures: exact percentiles with linear interpolation per group.

    Equal values of a group are counted before the shuffle, so a value that a third of the rows hold is one row with
    a weight.  These rows are range-partitioned by (group, value); a percentile's position is found first among the
    partitions, by prefix sums over one weight per group and partition, and then among the rows of
    the one partition that holds it.  No group is gathered in a task, however many distinct values it has.
    NULL values don't count; a NULL group is a group.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("__group"), F.col(value).alias("__value"))
              .agg(F.count("*").alias("__n")))
    rows = sorted_and_stored(counts, [F.col("__group").asc_nulls_first(), F.col("__value").asc()], "weighted")
    parts = rows.groupBy("__group", "__part").agg(F.sum("__n").alias("__held"))
    of_group = Window.partitionBy("__group")
    upto = F.sum("__held").over(of_group.orderBy("__part"))  # a row per partition that the group reaches
    parts = parts.select("__group", "__part", upto.alias("__upto"), (upto - F.col("__held")).alias("__before"),
                         F.sum("__held").over(of_group).alias("__all"))
    exact = lambda p: (F.col("__all") - 1) * F.lit(p)
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), (exact(p) - F.floor(exact(p))).alias("share"),
                                         F.array(F.floor(exact(p)), F.ceil(exact(p))).alias("at")) for n, p in shares.items()]))
    # Each partition keeps the positions that fall into it.
    wanted = (parts.withColumn("w", asked).select("__group", "__part", "__upto", "__before", "w.name", "w.share", F.posexplode("w.at"))
              .where((F.col("col") >= F.col("__before")) & (F.col("col") < F.col("__upto")))
              .select("__group", "__part", "name", "share", F.col("pos").alias("side"), (F.col("col") - F.col("__before")).alias("place")))
    asked_parts = wanted.select(F.col("__group").alias("g"), F.col("__part").alias("p")).distinct()
    here = rows.join(asked_parts, F.col("__group").eqNullSafe(F.col("g")) & (F.col("__part") == F.col("p")), "left_semi")
    last = F.sum("__n").over(Window.partitionBy("__group", "__part").orderBy("__at"))
    bounds = here.select(F.col("__group").alias("g"), F.col("__part").alias("p"), "__value", last.alias("to"), (last - F.col("__n")).alias("from"))
    hits = (wanted.join(bounds, F.col("__group").eqNullSafe(F.col("g")) & (F.col("__part") == F.col("p")))
            .where((F.col("place") >= F.col("from")) & (F.col("place") < F.col("to"))))
    found = hits.groupBy("__group", "name", "share").agg(F.max(F.when(F.col("side") == 0, F.col("__value"))).alias("low"),
                                                         F.max(F.when(F.col("side") == 1, F.col("__value"))).alias("high"))
    at = F.col("low") + (F.col("high") - F.col("low")) * F.col("share")
    return found.groupBy(F.col("__group").alias(group)).agg(*[F.max(F.when(F.col("name") == n, at)).alias(n) for n in shares])
