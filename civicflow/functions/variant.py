"""Semi-structured access: variant paths and safe parses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(raw: Column | str, key: str, type_: str = "string") -> Column:
    """``raw:key::type``; an absent key, a JSON null or a bad cast give NULL."""
    return F.try_variant_get(_col(raw), f"$.{key}", type_)


def json_fields(raw: Column | str, keys, type_: str = "string") -> Column:
    """X1 for many keys at once: one traversal of the variant into a struct
    (absent keys and JSON nulls are NULL fields; other keys are ignored)."""
    return F.try_variant_get(_col(raw), "$", "struct<" + ",".join(f"`{k}`:{type_}" for k in keys) + ">")


def has_path(raw: Column | str, key: str) -> Column:
    """the key is present (a JSON null counts as present, an absent key does not)."""
    return F.variant_get(_col(raw), f"$.{key}", "variant").isNotNull()


def parse_timestamp(c: Column | str) -> Column:
    """Safe ISO timestamp parse to ``timestamp_ntz``; bad or empty input is NULL."""
    return _col(c).try_cast("timestamp_ntz")


def parse_decimal(c: Column | str, precision: int = 18, scale: int = 12) -> Column:
    """Safe decimal parse; overflow or bad input is NULL."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def record_map(raw: Column | str) -> Column:
    """A record as ``map<string,string>`` in one traversal; NULL for what isn't an object."""
    return F.try_variant_get(_col(raw), "$", "map<string,string>")


def empty_string_count(record: Column | str) -> Column:
    """Number of top-level values equal to the empty string in a record's map; no object counts 0."""
    return F.coalesce(F.size(F.filter(F.map_values(_col(record)), lambda v: v == F.lit(""))), F.lit(0))
