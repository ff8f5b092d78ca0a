"""S3: bronze rows with defaults; a NULL payload or file name fails the load."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.fixed_values import SOURCE_TAG

BRONZE_COLUMNS = ("raw_data", "filename", "_extracted_at", "_source_relation")


def _required(column: str, type_: str):
    c = F.col(column)
    return F.when(c.isNull(), F.raise_error(F.lit(f"bronze.{column} is NULL")).cast(type_)).otherwise(c).alias(column)


def to_bronze(df: DataFrame, loaded_at: str | _dt.datetime | None = None,
              source: str = SOURCE_TAG) -> DataFrame:
    """Shape landed rows (``raw_data`` variant + ``filename``) into the bronze schema.

    ``_extracted_at`` defaults to ``loaded_at`` (the load time, one value per
    load; the current time when omitted) and ``_source_relation`` to the source tag.
    A row without payload or file name violates the table's not-null columns and raises.
    """
    stamp = F.current_timestamp() if loaded_at is None else F.lit(str(loaded_at))
    out = df
    if "_extracted_at" not in df.columns:
        out = out.withColumn("_extracted_at", stamp.cast("timestamp_ntz"))
    if "_source_relation" not in df.columns:
        out = out.withColumn("_source_relation", F.lit(source))
    return out.select(_required("raw_data", "variant"), _required("filename", "string"), "_extracted_at", "_source_relation")
