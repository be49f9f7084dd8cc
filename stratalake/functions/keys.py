"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a hashed key (public dbt_utils convention).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 hex over the '-'-joined string forms of ``cols``.

    The same inputs give the same key in every run, so facts can hash their
    foreign keys without joining the dimension.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *parts))


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as int. Arithmetic instead of format-then-parse: no string per row."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")
