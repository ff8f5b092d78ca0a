"""Landing zone: JSON record files -> bronze rows with file lineage.

Files are read as text and parsed record by record, so the limit on a variant's size
holds for one record and not for a file.  An array file that would not fit a task's memory is cut into pieces
that many tasks read (``split_arrays``).  Malformed JSON fails the load; ``landing_rejects`` lists it without failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.fixed_values import PAGE_SIZE
from civicflow.sources.split_arrays import split_array_records

SPLIT_BYTES = 256 << 20  # array files above this are read in pieces by many tasks


def _lineage(root: str, path_col: str = "_metadata.file_path") -> Column:
    """The source file path relative to the landing root (scheme stripped)."""
    root_rel = root.rstrip("/").split(":", 1)[-1] if root.startswith("file:") else root.rstrip("/")
    path = F.regexp_replace(F.col(path_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "")
    return F.regexp_replace(path, "^" + _re_escape(root_rel) + "/?", "")


def _re_escape(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def _is_blank(text: Column) -> Column:
    """Nothing but white space of any kind (and a byte-order mark)."""
    return text.rlike(r"^[\s\uFEFF]*\z")


def _is_array(text: Column) -> Column:
    return text.rlike(r"^[\s\uFEFF]*\[")


def records_from_text(df: DataFrame, root: str, layout: str = "array", path_col: str = "_metadata.file_path") -> DataFrame:
    """One row per record, ``raw_data`` variant + relative ``filename``, from text rows (``value``).

    ``array``: a row is a file; an outer array is stripped, a file holding one object is one record.
    ``lines``: a row is a line; blank lines are skipped.  Malformed JSON raises.
    """
    text = F.col("value")
    rows = df.select(text, _lineage(root, path_col).alias("filename")).where(~_is_blank(text))
    if layout == "lines":
        return rows.select(F.parse_json("value").alias("raw_data"), "filename")
    elements = F.from_json(text, "array<variant>", {"mode": "FAILFAST"})
    records = F.when(_is_array(text), elements).otherwise(F.array(F.parse_json(text)))
    return rows.select(F.explode(records).alias("raw_data"), "filename")


def _text(spark: SparkSession, root: str, layout: str) -> DataFrame:
    return spark.read.text(root, wholetext=layout == "array", recursiveFileLookup=True)


def large_files(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES) -> list[str]:
    """Paths of the files that hold more than ``split_bytes`` (listed without reading them)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return [r.path for r in files.where(F.col("length") > split_bytes).select("path").collect()]


def read_landing(spark: SparkSession, root: str, layout: str = "array", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """S1 + S2: one row per landed record at any folder depth.

    ``layout='array'``: each file is a JSON array of records (the API page format) or one record; files above
    ``split_bytes`` have to be arrays.
    ``layout='lines'``: one JSON object per line (what ``write_landing`` emits).
    """
    large = large_files(spark, root, split_bytes) if layout == "array" else []
    if not large:
        return records_from_text(_text(spark, root, layout), root, layout)
    split = split_array_records(spark, large).select("raw_data", _lineage(root, "file").alias("filename"))
    small = _text(spark, root, layout).where(F.col("_metadata.file_size") <= split_bytes)
    return records_from_text(small, root, layout).unionByName(split)


def landing_rejects(spark: SparkSession, root: str, layout: str = "array") -> DataFrame:
    """Texts that a load would fail on: (filename, bytes), one row per malformed file or line."""
    rows = _text(spark, root, layout).select("value", _lineage(root).alias("filename")).where(~_is_blank(F.col("value")))
    # try_parse_json can't hold a whole large file, so arrays are checked record by record as well.
    whole = F.from_json("value", "array<string>", {"mode": "PERMISSIVE"})
    bad = F.when(_is_array(F.col("value")), whole.isNull()).otherwise(F.try_parse_json("value").isNull()) if layout == "array" \
        else F.try_parse_json("value").isNull()
    return rows.where(bad).select("filename", F.octet_length("value").cast("long").alias("bytes"))


def write_landing_arrays(pages: DataFrame, day_root: str, page_col: str, payload_cols: list[str]) -> None:
    """Land records as JSON-array files, one file per page (the API page format).

    The caller's ``page_col`` must bound a page to at most ``PAGE_SIZE``
    records (an API page), so ``collect_list`` gathers a bounded group.
    """
    arrays = pages.groupBy(page_col).agg(
        F.to_json(F.collect_list(F.struct(*[F.col(c) for c in payload_cols]))).alias("value"))
    arrays.select("value").write.mode("append").option("maxRecordsPerFile", 1).text(day_root)


def write_landing(records: DataFrame, root: str, date_col: str = "ingest_date",
                  max_records_per_file: int = PAGE_SIZE, mode: str = "append") -> None:
    """Records -> JSON-lines files under ``<date_col>=YYYY-MM-DD/`` prefixes.

    At most ``max_records_per_file`` records per file (the page size); file
    names never contain ``:`` (unreadable by the Hadoop local file system).
    Null fields are omitted, so an absent key and a NULL read back the same.
    """
    (records.write.mode(mode).partitionBy(date_col)
     .option("maxRecordsPerFile", max_records_per_file).json(root))


def landing_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per date prefix of the landing zone.

    ``binaryFile`` with the content column pruned lists files in parallel and
    reads only metadata (path, length), never the bytes.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
             .select(_lineage(root).alias("filename"), F.col("length")))
    prefix = F.regexp_extract(F.col("filename"), r"(\d{4}-\d{2}-\d{2})", 1)
    return (files.groupBy(F.when(prefix == "", None).otherwise(prefix).alias("landing_date"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")))
