"""S1 for array files larger than a task: one file's records are read by many tasks.

The file is cut after every ``}``, which Spark's text reader does within file splits, so a piece is
small and pieces of one file lie in many tasks.  Whether a ``}`` ends a record depends on all the text before
it: on being inside a string or not, and on how many braces are open.  Both are prefix sums.  Each piece
states what it adds (quotes, and braces for either answer to "does it start inside a string"), sums over a split's
pieces give what the split adds, a window over a file's splits (a row each) gives what it starts with, and a
window over a split's pieces settles each of them.  Pieces between two record ends are put together by record.

Every check of a whole-file parse is made: separators between records, the brackets around them, and what follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicflow.session import scratch_path

_SPLIT = ["file", "start"]
# Escaped characters say nothing about quotes.  A piece ends at a brace, so no escape pair is cut.
_PLAIN = r"(?s)\\."
_STRING = r'"[^"]*"'
_OPENS_IN_STRING = r'^[^"]*"'
_OPEN_STRING = r'"[^"]*$'


def _braces(text: Column) -> Column:
    """Opened braces of a text without strings."""
    return F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))


def _outside(plain: Column, inside: bool) -> Column:
    """What of a piece without escapes lies outside strings, if it starts inside of one or not."""
    rest = F.regexp_replace(plain, _OPENS_IN_STRING, "") if inside else plain
    if inside:  # without a quote the whole piece is string
        rest = F.when(F.contains(plain, F.lit('"')), rest).otherwise(F.lit(""))
    return F.regexp_replace(F.regexp_replace(rest, _STRING, ""), _OPEN_STRING, "")


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, at, text, closes, quotes, opens_out, opens_in): pieces in order of (start, at) within a file.

    ``closes``: whether a brace follows the piece; not for the last one of a file.
    """
    rows = spark.read.text(paths, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    plain = F.regexp_replace("text", _PLAIN, "")
    quotes = F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))
    return rows.withColumn("plain", plain).select(
        "file", "start", "size", "at", "text", (quotes % 2).alias("quotes"),
        _braces(_outside(F.col("plain"), False)).alias("opens_out"), _braces(_outside(F.col("plain"), True)).alias("opens_in"))


def _running(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _with_state(pieces: DataFrame, added: str, name: str) -> DataFrame:
    """``pieces`` with the sum of ``added`` over all pieces of the file before each one."""
    splits = pieces.groupBy(*_SPLIT).agg(F.sum(added).alias("all"))
    starts = splits.select(*_SPLIT, _before("all", _running(["file"], ["start"])).alias("base"))  # a row per split
    within = pieces.withColumn("within", _before(added, _running(_SPLIT, ["at"])))
    return within.join(starts, _SPLIT).withColumn(name, F.col("base") + F.col("within")).drop("base", "within")


def _bad(why: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"malformed array file ({why}): "), F.col("file")))


def split_array_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, raw_data): one row per record of array files of any size.  A malformed file fails the load."""
    path = scratch_path(spark, "array-pieces")
    _pieces(spark, paths).write.parquet(path)  # cut once, used by every sum below
    pieces = spark.read.parquet(path)
    ends = pieces.groupBy("file").agg(F.max(F.struct("start", "at")).alias("end"), F.max("size").alias("size"),
                                      F.sum(F.octet_length("text") + 1).alias("bytes"))
    # The reader doesn't tell whether a brace follows the last piece; the file's size does (it leaves a byte-order mark out).
    # One that does is no array's end.
    cut = F.col("bytes").isin(F.col("size"), F.col("size") - 3)
    ends = ends.select("file", F.when(cut, _bad("it ends with a brace").cast("struct<start:bigint,at:bigint>")).otherwise(F.col("end")).alias("end"))
    # A row per file goes to every task: joined by a shuffle, all of a file's text would meet in one task, windows below included.
    pieces = pieces.join(F.broadcast(ends), "file").withColumn("closes", F.struct("start", "at") != F.col("end")).drop("end")
    quoted = _with_state(pieces, "quotes", "quotes_before")
    inside = F.col("quotes_before") % 2 == 1
    ends_inside = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    counted = quoted.withColumn("net", F.when(inside, F.col("opens_in")).otherwise(F.col("opens_out"))
                                - (F.col("closes") & ~ends_inside).cast("int"))
    deep = _with_state(counted.select("file", "start", "at", "text", "closes", "net", ends_inside.alias("ends_inside")), "net", "depth")
    after = F.col("depth") + F.col("net")
    ended = deep.withColumn("ends", (F.col("closes") & ~F.col("ends_inside") & (after == 0)).cast("int")).withColumn("after", after)
    numbered = _with_state(ended, "ends", "record")
    text = F.concat("text", F.when(F.col("closes"), "}").otherwise(""))
    records = numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", text.alias("t")))), lambda p: p["t"]), "").alias("t"),
        F.max("ends").alias("whole"), F.min("after").alias("least"))
    lead = F.regexp_extract("t", r"^([\s\uFEFF]*[\[,]?\s*)", 1)
    opening = F.regexp_replace(lead, r"[\s\uFEFF]", "")
    body = F.expr("substring(t, length(lead) + 1)")
    split = records.withColumn("lead", lead).withColumn("opening", opening).withColumn("body", body)
    record = (F.when(F.col("least") < 0, _bad("a brace too many").cast("variant"))
              .when(F.col("opening") != F.when(F.col("record") == 0, "[").otherwise(","), _bad("no separator before a record").cast("variant"))
              .otherwise(F.parse_json("body")))
    tail = F.regexp_replace("t", r"[\s\uFEFF]", "")
    ending = F.when(F.col("record") == 0, "[]").otherwise("]")
    rest = F.when(tail != ending, _bad("it doesn't end with its records").cast("variant"))
    return (split.withColumn("raw_data", F.when(F.col("whole") == 1, record).otherwise(rest))
            .where((F.col("whole") == 1) | F.col("raw_data").isNotNull()).select("file", "raw_data"))
