"""Column-level building blocks (JVM-side expressions only, no Python UDFs)."""

from stratalake.functions.keys import SURROGATE_NULL, date_key, surrogate_key
from stratalake.functions.temporal import (
    calendar_days,
    full_days,
    iso_weekday,
    month_label,
    parse_date,
    parse_timestamp,
    unix_to_timestamp,
)
from stratalake.functions.text import (
    digits_only,
    extract_first,
    norm_default,
    norm_lower,
    norm_upper,
    strip,
)

__all__ = [
    "SURROGATE_NULL",
    "calendar_days",
    "date_key",
    "digits_only",
    "extract_first",
    "full_days",
    "iso_weekday",
    "month_label",
    "norm_default",
    "norm_lower",
    "norm_upper",
    "parse_date",
    "parse_timestamp",
    "strip",
    "surrogate_key",
    "unix_to_timestamp",
]
