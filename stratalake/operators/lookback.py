"""Incremental selection of recent rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.temporal import now_ts

# Fixed value: days re-read by every incremental run.
LOOKBACK_DAYS = 2


def lookback_start(now: dt.datetime | str | Column | None = None, days: int = LOOKBACK_DAYS) -> Column:
    return now_ts(now) - F.make_dt_interval(days=F.lit(days))


def within_lookback(
    column: str, now: dt.datetime | str | Column | None = None, days: int = LOOKBACK_DAYS
) -> Column:
    return F.col(column) >= lookback_start(now, days)


def lookback(
    df: DataFrame,
    column: str,
    now: dt.datetime | str | Column | None = None,
    days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """Rows whose watermark is at most ``days`` old; a bare column comparison, so it reaches the scan."""
    return df.filter(within_lookback(column, now, days))


def since_high_water(
    batch: DataFrame, target: DataFrame, column: str, days: int = 1
) -> DataFrame:
    """Rows at or after the target's maximum watermark minus ``days``.

    The bound is one row, computed by Spark and carried as text in the column's own
    type: no time zone of the driver enters. As a literal it is pushed down into the
    scan of ``batch``. An empty target selects everything.
    """
    kind = batch.schema[column].dataType
    bound = (F.max(column) - F.make_dt_interval(days=F.lit(days))).cast(kind).cast("string")
    low = target.agg(bound.alias("low")).first()["low"]
    return batch if low is None else batch.filter(F.col(column) >= F.lit(low).cast(kind))
