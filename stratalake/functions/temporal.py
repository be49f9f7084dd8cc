"""Date and time arithmetic on zone-less timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The "today" of a build: explicit for reproducible runs, else the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def now_ts(now: dt.datetime | str | Column | None) -> Column:
    """The "now" of a build as a zone-less timestamp."""
    if now is None:
        return F.localtimestamp()
    if isinstance(now, Column):
        return now.cast("timestamp_ntz")
    return F.lit(str(now)).cast("timestamp_ntz")


def iso_weekday(c: Column | str) -> Column:
    """Monday=1 .. Sunday=7."""
    return (F.weekday(_col(c)) + 1).cast("int")


def month_label(c: Column | str) -> Column:
    """'YYYY-MM'."""
    return F.date_format(_col(c), "yyyy-MM")


def calendar_days(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed between two dates."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def full_days(start: Column | str, end: Column | str) -> Column:
    """Complete 24-hour periods between two zone-less timestamps.

    Interval arithmetic on TIMESTAMP_NTZ does not depend on the session time
    zone, so daylight saving cannot shift the count.
    """
    span = _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("bigint")


def parse_date(c: Column | str, fmt: str) -> Column:
    return F.to_date(_col(c), fmt)


def parse_timestamp(c: Column | str, fmt: str) -> Column:
    return F.to_timestamp_ntz(_col(c), F.lit(fmt))


def unix_to_timestamp(c: Column | str) -> Column:
    """Seconds since the epoch to a zone-less UTC timestamp."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=_col(c).cast("decimal(18,6)"))
