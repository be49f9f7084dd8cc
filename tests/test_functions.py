from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("\tab c ", "AB C"), ("  ", ""), (None, None), ("　x\n", "X"), ("a\tb", "A\tB")],
)
def test_norm_upper_removes_any_whitespace(spark, raw, expected):
    assert one(spark, fn.norm_upper(F.lit(raw).cast("string"))) == expected


def test_email_and_defaults(spark):
    assert one(spark, fn.norm_lower(F.lit(" Ana@X.Com "))) == "ana@x.com"
    assert one(spark, fn.norm_default(F.lit(None).cast("string"), "NA")) == "NA"
    assert one(spark, fn.norm_default(F.lit(None).cast("string"), "")) == ""


@pytest.mark.parametrize(("raw", "expected"), [("12.3-4/x", "1234"), (None, ""), ("abc", "")])
def test_digits_only(spark, raw, expected):
    assert one(spark, fn.digits_only(F.lit(raw).cast("string"))) == expected


def test_surrogate_key_formula(spark):
    parts = "unit_01-_dbt_utils_surrogate_key_null_-2024-01-31"
    key = fn.surrogate_key(
        F.lit("unit_01"), F.lit(None).cast("string"), F.lit(dt.date(2024, 1, 31))
    )
    assert one(spark, key) == hashlib.md5(parts.encode()).hexdigest()


def test_surrogate_key_separates_tenants(spark):
    a = one(spark, fn.surrogate_key(F.lit("unit_01"), F.lit("C1")))
    assert a != one(spark, fn.surrogate_key(F.lit("unit_02"), F.lit("C1")))


def test_date_key_and_month(spark):
    ts = F.lit("2024-02-09 23:59:59").cast("timestamp_ntz")
    assert one(spark, fn.date_key(ts)) == 20240209
    assert one(spark, fn.month_label(ts)) == "2024-02"


@pytest.mark.parametrize(("day", "n"), [("2024-01-06", 6), ("2024-01-07", 7), ("2024-01-08", 1)])
def test_iso_weekday(spark, day, n):
    assert one(spark, fn.iso_weekday(F.lit(day).cast("date"))) == n


def test_full_days_differ_from_calendar_days(spark):
    start, end = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"), F.lit("2024-01-03").cast("date")
    assert one(spark, fn.full_days(start, end)) == 1
    assert one(spark, fn.calendar_days(start.cast("date"), end)) == 2


def test_full_days_ignores_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # a zone with a daylight saving change inside the interval
        start = F.lit("2018-11-03 12:00:00").cast("timestamp_ntz")
        end = F.lit("2018-11-05 12:00:00").cast("timestamp_ntz")
        assert one(spark, fn.full_days(start, end)) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parsing(spark):
    assert one(spark, fn.parse_date(F.lit("31/12/2024"), "dd/MM/yyyy")) == dt.date(2024, 12, 31)
    assert one(spark, fn.parse_timestamp(F.lit("31/12/2024 10"), "dd/MM/yyyy HH")) == dt.datetime(
        2024, 12, 31, 10
    )
    assert one(spark, fn.unix_to_timestamp(F.lit(86400))) == dt.datetime(1970, 1, 2)
    assert one(spark, fn.extract_first(F.lit("k=12"), r"k=(\d+)", 1)) == "12"
    assert one(spark, fn.extract_first(F.lit("none"), r"k=(\d+)", 1)) is None


def test_money_rounds_half_up(spark):
    assert one(spark, F.lit("1.005").cast("decimal(18,3)").cast("decimal(18,2)")) == Decimal("1.01")
