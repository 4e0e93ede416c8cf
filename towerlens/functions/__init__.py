"""Column-level helpers built only from ``pyspark.sql.functions``."""

from towerlens.functions.casts import lenient_cast, lenient_double, lenient_int, python_strip
from towerlens.functions.timeparts import (
    batch_window, calendar_parts, hour_label, ingest_parts, parse_range_hours,
    range_bound_text, to_utc_timestamp_col, zero_padded_parts,
)

__all__ = [
    "lenient_cast", "lenient_double", "lenient_int", "python_strip",
    "batch_window", "calendar_parts", "hour_label", "ingest_parts",
    "parse_range_hours", "range_bound_text", "to_utc_timestamp_col",
    "zero_padded_parts",
]
