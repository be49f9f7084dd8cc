from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_of
from stratalake.operators import upsert as merge
from stratalake.operators.upsert import DuplicateKeys, finish_interrupted, upsert
from stratalake.operators.lookback import lookback, since_high_water

DDL = "tenant_id string, k string, at int, v string"
KEYS = ("tenant_id", "k")


def test_insert_and_replace(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x"), ("b", "1", 1, "y")), t, KEYS)
    upsert(rows(DDL, ("a", "1", 0, "z"), ("a", "2", 1, "n")), t, KEYS)
    assert as_set(spark.table(t).select("tenant_id", "k", "at", "v")) == {
        ("a", "1", 0, "z"), ("a", "2", 1, "n"), ("b", "1", 1, "y"),
    }


def test_untouched_partitions_keep_their_files(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x"), ("b", "1", 1, "y")), t, KEYS)
    files = lambda: {r[0] for r in spark.table(t).filter("tenant_id='b'").select("_metadata.file_path").collect()}
    before = files()
    upsert(rows(DDL, ("a", "1", 2, "z")), t, KEYS)
    assert files() == before


def test_older_rows_never_win(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 5, "x")), t, KEYS, order_by="at")
    upsert(rows(DDL, ("a", "1", 3, "late"), ("a", "1", 4, "late2")), t, KEYS, order_by="at")
    assert as_set(spark.table(t).select("at", "v")) == {(5, "x")}
    upsert(rows(DDL, ("a", "1", 5, "same time")), t, KEYS, order_by="at")
    assert as_set(spark.table(t).select("at", "v")) == {(5, "same time")}


def test_duplicate_batch_keys_are_rejected(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x")), t, KEYS)
    with pytest.raises(DuplicateKeys):
        upsert(rows(DDL, ("a", "2", 1, "p"), ("a", "2", 1, "q")), t, KEYS)
    assert spark.table(t).count() == 1


def test_null_key_parts_do_not_multiply(spark, lake, rows):
    t = lake.name("silver", "t")
    for _ in range(2):
        upsert(rows(DDL, ("a", None, 1, "x")), t, KEYS)
    assert spark.table(t).count() == 1


def test_new_columns_are_appended(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x"), ("b", "1", 1, "y")), t, KEYS)
    upsert(rows(DDL + ", extra int", ("a", "2", 1, "n", 7)), t, KEYS)
    upsert(rows(DDL, ("a", "3", 1, "m")), t, KEYS)  # a batch without the new column
    assert as_set(spark.table(t).select("tenant_id", "k", "extra")) == {
        ("a", "1", None), ("b", "1", None), ("a", "2", 7), ("a", "3", None),
    }
    with pytest.raises(ValueError):
        upsert(rows(DDL + ", more int", ("a", "4", 1, "n", 7)), t, KEYS, on_schema_change="fail")
    upsert(rows(DDL + ", more int", ("a", "4", 1, "n", 7)), t, KEYS, on_schema_change="ignore")
    assert "more" not in spark.table(t).columns


def test_key_that_changes_partition_moves(spark, lake, rows):
    t = lake.name("silver", "t")
    ddl = "tenant_id string, k string, mes int, v string"
    by = ("tenant_id", "mes")
    upsert(rows(ddl, ("a", "1", 1, "x"), ("a", "2", 2, "y")), t, KEYS, by)
    upsert(rows(ddl, ("a", "1", 2, "moved")), t, KEYS, by)
    assert as_set(spark.table(t).select("k", "mes", "v")) == {("1", 2, "moved"), ("2", 2, "y")}


def test_many_partitions_are_pruned(spark, tmp_path):
    """More than 400 touched partitions of two columns still prune directories."""
    path = str(tmp_path / "t")
    values = spark.range(450).select(F.col("id").cast("int").alias("mes"), F.lit("x").alias("v"), F.when(F.col("id") > 5, F.lit("a")).alias("tenant_id"))
    values.write.partitionBy("tenant_id", "mes").parquet(path)
    target = spark.read.parquet(path)
    touched = target.filter("mes >= 20 or mes = 3").select("tenant_id", "mes")
    got = merge.restrict_to(target, touched, ["tenant_id", "mes"])
    assert got.count() == 431
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan_of(got)).group(1)
    assert "mes" in filters and "tenant_id" in filters


def test_replaced_groups_go_without_a_new_row(spark, lake, rows):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x"), ("a", "2", 1, "y"), ("b", "1", 1, "x"), ("b", "3", 2, "z")), t, KEYS)
    upsert(rows(DDL, ("a", "9", 3, "new")), t, KEYS, replaces=rows("tenant_id string, v string", ("a", "x"), ("b", "z"), ("c", "x")))
    assert as_set(spark.table(t).select("tenant_id", "k", "v")) == {("a", "2", "y"), ("a", "9", "new"), ("b", "1", "x")}


def test_interrupted_replacement_is_finished(spark, lake, rows, monkeypatch):
    t = lake.name("silver", "t")
    upsert(rows(DDL, ("a", "1", 1, "x"), ("b", "1", 1, "y")), t, KEYS)

    def die(*_args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(merge, "overwrite_partitions", die)
        with pytest.raises(RuntimeError):
            upsert(rows(DDL, ("a", "1", 2, "new")), t, KEYS)
    assert as_set(spark.table(t).select("k", "v")) == {("1", "x"), ("1", "y")}
    finish_interrupted(spark, t)
    assert as_set(spark.table(t).select("tenant_id", "v")) == {("a", "new"), ("b", "y")}
    finish_interrupted(spark, t)  # nothing left to do


def test_batches_in_any_order_equal_one_build(spark, lake, rows):
    random.seed(7)
    data = [(random.choice("ab"), str(random.randrange(6)), n, random.choice("xyz")) for n in range(60)]
    whole, parts = lake.name("silver", "whole"), lake.name("silver", "parts")
    upsert(rows(DDL, *data), whole, KEYS, order_by="at")
    shuffled = data[:]
    random.shuffle(shuffled)
    for i in range(0, 60, 20):
        for _ in range(2 if i == 20 else 1):  # one batch is delivered twice
            upsert(rows(DDL, *shuffled[i : i + 20]), parts, KEYS, order_by="at")
    assert as_set(spark.table(whole).select("tenant_id", "k", "at", "v")) == as_set(
        spark.table(parts).select("tenant_id", "k", "at", "v")
    )


def test_lookback_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.range(5).select(F.expr("timestamp_ntz'2025-01-01' + make_dt_interval(id) ts")).write.parquet(path)
    recent = lookback(spark.read.parquet(path), "ts", "2025-01-05 00:00:00")
    assert recent.count() == 3
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2025-01-03T00:00)]" in plan_of(recent)


def test_high_water_mark_ignores_the_drivers_zone(rows, monkeypatch):
    df = rows("v int", *[(v,) for v in range(25)]).select(
        F.expr("timestamp_ntz'2025-01-01' + make_dt_interval(0, v) ts"), F.expr("timestamp'2025-01-01' + make_dt_interval(0, v) tz"), "v"
    )
    for column in ("ts", "tz"):
        for zone in ("America/Sao_Paulo", "Asia/Tokyo", "UTC"):
            monkeypatch.setenv("TZ", zone)
            time.tzset()
            assert since_high_water(df, df, column).count() == 25
            assert since_high_water(df, df.filter("v = 0"), column, days=0).count() == 25
            assert since_high_water(df, df.filter("v = 20"), column, days=0).count() == 5
    monkeypatch.delenv("TZ")
    time.tzset()


def test_high_water_mark(rows):
    df = rows("v int", (1,), (2,), (3,), (4,)).select(
        F.expr("timestamp_ntz'2025-01-01' + make_dt_interval(v) ts"), "v"
    )
    assert as_set(since_high_water(df, df.filter("v <= 3"), "ts").select("v")) == {(2,), (3,), (4,)}
    assert since_high_water(df, df.limit(0), "ts").count() == 4
