"""Scalar column functions (X1-X22).  Each returns a ``Column`` built only from
``pyspark.sql.functions``, so it stays inside whole-stage codegen / the JVM."""

from civicflow.functions.flags import has_any, has_value, is_open, is_resolved  # noqa: F401
from civicflow.functions.keys import surrogate_key  # noqa: F401
from civicflow.functions.text import blank_to_null, placeholder_to_null, title_case, within  # noqa: F401
from civicflow.functions.time import (  # noqa: F401
    age_bucket, day_diff, day_name, hour_diff, month_start, week_start,
)
from civicflow.functions.variant import (  # noqa: F401
    empty_string_count, json_field, parse_decimal, parse_timestamp,
)
