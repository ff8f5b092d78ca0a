"""Mixing sources to target weights by capped water-filling; DataFrame operations only.

Every source has a weight.  The pool (the size of all sources together) is shared by
weight; a source whose share exceeds ``max_epochs`` times its size is clamped there, and
what it can't take is shared again by weight among the others, until none is above.

A source whose target is e + f times its size takes every document e times and a seeded
sample a further time, until the sample holds the remaining words.  The sample is a
prefix of the documents in the order of a seeded hash.  Its end is found by two levels of
hash buckets (256 each), so no task ever sorts a source: a window sees 256 bucket sums,
and at last the documents of one bucket out of 65 536.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicflow.llm.common import stored

MAX_EPOCHS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``weight``: the cycle's values in turn, sources by code point, NULL last.

    ``sources`` has one row per source (already aggregated), so the window over it sees source
    names only, however many rows a source has.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (turn % len(cycle) + 1).cast("int")).cast("long"))


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` (double) to sources (source, source_size, weight).

    Each round is one aggregate: what is left of the pool and of the weights.  The driver sees these
    two sums only.  Sources are compared in whole numbers, so every run clamps the same ones.
    """
    capped = F.lit(False)
    cap = F.col("source_size") * max_epochs
    pool = None
    while True:
        left, weights, n = sources.select("*", capped.alias("capped")).agg(
            F.sum("source_size") - F.coalesce(F.sum(F.when(F.col("capped"), cap)), F.lit(0)),
            F.sum(F.when(~F.col("capped"), F.col("weight"))), F.count_if("capped")).first()
        if not weights or (left, weights, n) == pool:
            break
        pool = (left, weights, n)
        # Once clamped, always clamped: the level only rises.
        over = cap.cast("decimal(38,0)") * F.lit(weights) < F.col("weight").cast("decimal(38,0)") * F.lit(left)
        capped = capped | over
    left, weights = (left or 0), (weights or 1)
    share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights))
    return sources.withColumn("target", F.when(capped, cap.cast("double")).otherwise(share).cast("double"))


def plan_mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): a row (doc_id, source, size, order) per document, written once, and a row per source."""
    rows = stored(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"),
                              F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("order")), "mix-rows")
    sources = cyclic_weights(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    filled = water_fill(stored(sources, "mix-sources"), max_epochs)
    words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0).cast("long")
    return rows, (filled.withColumn("epochs", epochs)
                  .withColumn("extra", words - F.col("epochs") * F.col("source_size")))


def _boundary(rows: DataFrame, level: int, need: str) -> DataFrame:
    """Per source: the bucket (2 * level hex digits of the order) in which the running size reaches ``need``.

    Sums per bucket combine before the shuffle; the window over a source sees 256 sums at most.
    """
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    sums = rows.groupBy("source", need, F.substring("order", 1, 2 * level).alias("bucket")).agg(F.sum("size").alias("words"))
    last = sums.withColumn("upto", running).where(F.col("upto") >= F.col(need))
    return last.groupBy("source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")), "bucket").alias("b"))


def _plan(docs: DataFrame, max_epochs: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(all rows with their source's plan, sources): a row below its source's end bucket is sampled whole."""
    rows, sources = plan_mix(docs, max_epochs, seed)
    sources = stored(sources.select("source", "source_size", "target", "epochs", "extra"), "mix-targets")
    same = lambda d, e: d.source.eqNullSafe(e.source)
    asked = sources.where("extra > 0").select("source", "extra")
    wanted = rows.join(asked, same(rows, asked)).select(rows.source, "size", "order", "extra")
    first = stored(_boundary(wanted, 1, "extra"), "mix-first")
    inside = (wanted.join(first, same(wanted, first)).where(F.substring("order", 1, 2) == F.col("b.bucket"))
              .select(wanted.source, "size", "order", (F.col("extra") - F.col("b.before")).alias("rest")))
    second = stored(_boundary(inside, 2, "rest"), "mix-second")
    ends = (sources.join(first.select(F.col("source").alias("s1"), F.col("b").alias("b1")), F.col("source").eqNullSafe(F.col("s1")), "left")
            .join(second.select(F.col("source").alias("s2"), F.col("b").alias("b2")), F.col("source").eqNullSafe(F.col("s2")), "left")
            .select("source", "source_size", "target", "epochs", F.col("b2.bucket").alias("end"),
                    (F.col("extra") - F.col("b1.before") - F.col("b2.before")).alias("rest")))
    ends = stored(ends, "mix-ends")
    return rows.join(ends, same(rows, ends)).select(
        rows.doc_id, rows.source, rows.size, rows.order, "source_size", "target", "epochs", "end", "rest"), ends


def _at_end(rows: DataFrame) -> DataFrame:
    """The rows of each source's end bucket, with the words that the sample takes of them.

    Rows equal in order, id and size are interchangeable, so they are counted first; a source's window sees
    one row for each.  Only in the one group at the sample's end are rows told apart, by their
    number in their partition and the partition's offset, so repeated ids make no hot window.
    """
    kind = ["source", "order", "doc_id", "size"]
    at_end = rows.where(F.substring("order", 1, 4) == F.col("end"))
    before = F.coalesce(F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("source").orderBy("order", "doc_id", "size")
                                                               .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = at_end.groupBy(*kind).agg(F.count("*").alias("n"), F.max("rest").alias("left")).withColumn("due", F.greatest(F.lit(0), F.col("left") - before))
    groups = stored(groups.select(*[F.col(c).alias(f"g_{c}") for c in kind], "n", F.least(F.col("due"), F.col("size") * F.col("n")).alias("due")), "mix-end")
    same = F.lit(True)
    for c in kind:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    met = stored(at_end.join(groups, same).drop(*[f"g_{c}" for c in kind]).withColumn("id", F.monotonically_increasing_id()), "mix-end-rows")
    split = (F.col("due") > 0) & (F.col("due") < F.col("size") * F.col("n"))
    settled = met.where(~split).withColumn("sampled", F.when(F.col("due") > 0, F.col("size")).otherwise(0).cast("long"))
    part = F.shiftright("id", 33)
    parts = met.where(split).groupBy("source", part.alias("part")).agg(F.count("*").alias("held"))
    offset = F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select(F.col("source").alias("of"), F.col("part").alias("in"), offset.alias("offset"))
    nth = F.row_number().over(Window.partitionBy("source", "part").orderBy("id"))
    told = (met.where(split).withColumn("part", part).withColumn("nth", nth)
            .join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in"))))
    rest = F.col("due") - (F.col("offset") + F.col("nth") - 1) * F.col("size")
    told = told.withColumn("sampled", F.least(F.col("size"), F.greatest(F.lit(0), rest)).cast("long"))
    return settled.select(*rows.columns, "sampled").unionByName(told.select(*rows.columns, "sampled"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, epochs, sampled, taken.

    ``taken`` words are ``epochs`` whole repetitions and ``sampled`` words of one more: all of the
    document's words for a sampled one, none for the others, a part for the one document of each
    source at the end of the sample, so that a source takes its target to the word.  NULL sources
    are a source of their own, last in order.  NULL, empty and blank texts have size 0 and are taken
    0 words.  Repeated ids share an order; their rows are taken one after the other, by size.  Sources
    without any words have target 0.  Other columns are ignored; an empty table gives no rows.
    """
    rows, _ = _plan(docs, max_epochs, seed)
    out = ["doc_id", "source", "size", "source_size", "target", "epochs", "sampled"]
    bucket = F.substring("order", 1, 4)
    whole = (rows.where(~F.coalesce(bucket == F.col("end"), F.lit(False)))
             .withColumn("sampled", F.when(bucket < F.col("end"), F.col("size")).otherwise(0).cast("long")))
    both = whole.select(out).unionByName(_at_end(rows).select(out))
    return both.withColumn("taken", F.col("epochs") * F.col("size") + F.col("sampled"))


def mixed_documents(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` as the mix repeats them: same columns, each row as many times as it is taken.

    Documents stay whole: the one at the end of a source's sample counts if at least half of it is
    due.  The plan comes down to one row per source (repetitions and the last order sampled), so
    texts meet a table of sources and don't shuffle by document.  Rows without words are kept once,
    since they cost the mix nothing; rows that the mix takes no time are left out.  NULL sources are a source;
    rows of one id (repeated rows, NULL ids) are sampled together; an empty table gives no rows.
    """
    rows, ends = _plan(docs, max_epochs, seed)
    last = (_at_end(rows).where((F.col("sampled") > 0) & (F.col("sampled") * 2 >= F.col("size")))
            .groupBy("source").agg(F.max("order").alias("last")))
    per_source = stored(ends.join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
                        .select(F.col("source").alias("of"), "epochs", "end", "last"), "mix-sources")
    held = docs.select(F.struct("*").alias("row"), F.col("source").alias("from"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("order"),
                       (words_in(F.col("text")) > 0).alias("has_words"))
    sampled = F.coalesce((F.substring("order", 1, 4) < F.col("end")) | (F.col("order") <= F.col("last")), F.lit(False))
    times = F.when(F.col("has_words"), F.col("epochs") + sampled.cast("long")).otherwise(1).cast("int")
    return (held.join(per_source, F.col("from").eqNullSafe(F.col("of"))).withColumn("times", times).where("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*"))
