from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import as_set
from stratalake.operators import quality as q
from stratalake.plans import checks
from stratalake.session import scratch_path
from stratalake.sources import bronze

D = Decimal


def test_all_declared_tests_are_there():
    assert checks.count_declared() == {
        "not_null": 189, "unique": 18, "unique_combination": 32, "accepted_values": 14, "relationships": 23,
    }
    assert len(checks.DECLARED) == 45


def test_null_rules(rows):
    df = rows("a string, b string", ("x", "1"), ("x", "1"), (None, None), (None, None), ("y", "2"))
    assert as_set(q.null_counts(df, ["a", "b"])) == {("a", 2), ("b", 2)}
    assert q.not_null(df, "a").count() == 2
    assert as_set(q.unique(df, "a")) == {("x", 2)}  # NULLs are not duplicates of each other
    assert as_set(q.unique_combination(df, ["a", "b"])) == {("x", "1", 2), (None, None, 2)}
    assert as_set(q.accepted_values(df, "a", ["y"])) == {("x", 2)}
    parent = rows("k string", ("y",), (None,))
    assert as_set(q.relationships(df, "a", parent, "k")) == {("x", 2)}
    assert q.orphan_rows(df, "a", parent, "k").count() == 2


def test_passing_checks_return_nothing(rows):
    df = rows("a string", ("x",), ("y",))
    assert q.null_counts(df, ["a"]).count() == 0
    assert q.unique(df, "a").count() == 0
    assert q.relationships(df, "a", df, "a").count() == 0


def test_total_consistency_tolerates_one_cent(rows):
    ddl = "k string, q decimal(18,4), u decimal(18,2), t decimal(18,2)"
    df = rows(ddl, ("exact", D(2), D("1.50"), D("3.00")), ("cent", D(2), D("1.50"), D("3.01")), ("two", D(2), D("1.50"), D("3.02")))
    assert as_set(q.total_mismatch(df, ["k"], "t", "q", "u").select("k", "divergencia")) == {("two", D("0.020000"))}


def test_tenant_leak_and_negative_lateness(rows):
    df = rows("tenant_id string, d int", ("unit_01", 0), ("unit_02", -1), ("unit_02", 2))
    assert as_set(q.tenant_leak(df, "unit_01")) == {("unit_02", 2)}
    assert as_set(q.negative_values(df, ["tenant_id"], "d")) == {("unit_02", -1)}


def test_ranges(rows):
    df = rows("g string, v int", ("a", 1), ("a", 5), ("b", 9), ("b", None))
    assert as_set(q.outside_range(df, "v", 2, 8).select("v")) == {(1,), (9,)}
    assert as_set(q.outside_range(df, "v", low=2).select("v")) == {(1,)}
    assert q.volume_outside(df, ["g"], 2).count() == 0
    assert as_set(q.volume_outside(df, ["g"], 3)) == {("a", 2), ("b", 2)}
    assert q.row_count_outside(df, 1, 4).count() == 0 and q.row_count_outside(df, 5, 9).count() == 1
    assert q.column_set_mismatch(df, ["g", "w"]) == ["v", "w"]


def test_unbalanced_entries(rows):
    df = rows(
        "tenant_id string, p int, cd_tipo_lancamento string, vlr_lancamento decimal(18,2)",
        ("u", 1, "DEBITO", D(5)), ("u", 1, "CREDITO", D(5)), ("u", 2, "DEBITO", D(5)),
    )
    assert as_set(q.unbalanced_entries(df, "p")) == {("u", 2, D("5.00"), D("0.00"))}


def test_reconcile(rows):
    a = rows("k string, v decimal(18,2)", ("same", D(1000)), ("near", D(1000)), ("far", D(1000)), ("left", D(1)), (None, D(1)))
    b = rows("k string, v decimal(18,2)", ("same", D(1000)), ("near", D(1001)), ("far", D(1002)), ("right", D(1)), (None, D(1)))
    assert as_set(q.reconcile(a, b, ["k"], "v").select("k")) == {("far",), ("left",), ("right",)}


def test_differing_rows(spark, rows):
    kind = "bucket long, h string, v decimal(18,2)"  # names used inside as well
    base = [(i, f"s{i}", D(i)) for i in range(300)] + [(7, "s7", D(7)), (None, None, None), (None, "x", None)]
    a = rows(kind, *base, (1000, None, D(1)), (2000, "left", D(2)))
    b = rows(kind, *reversed(base), (7, "s7", D(7)), (1000, "", D(1)))
    for buckets in (1, 16, 65_536):
        got = as_set(q.differing_rows(a, b.select("v", "bucket", "h"), buckets))
        assert got == {(7, "s7", D(7), 2, 3), (1000, None, D(1), 1, 0), (1000, "", D(1), 0, 1), (2000, "left", D(2), 1, 0)}
    assert q.differing_rows(a, a).count() == 0
    assert q.differing_rows(a.limit(0), a.limit(0)).count() == 0
    assert q.differing_rows(a, a.limit(0)).count() == a.distinct().count()
    with pytest.raises(ValueError, match="columns differ"):
        q.differing_rows(a, a.drop("v"))


def test_only_rows_of_differing_buckets_are_grouped(spark):
    a = spark.range(20_000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 77, "other").otherwise(F.col("v")))
    got = q.differing_rows(a, b)
    assert as_set(got) == {(77, "v77", 1, 0), (77, "other", 0, 1)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and plan.index("BroadcastHashJoin") > plan.index("HashAggregate")  # filtered before the grouping


FEED = "tenant_id string, year int, month int, day int"


def test_partition_gate_and_completeness(spark, rows):
    feed = rows(FEED, ("unit_01", 2025, 4, 1), ("unit_01", 2025, 4, 1), ("unit_02", 2025, 4, 2))
    assert q.require_partition(feed, "unit_01", dt.date(2025, 4, 1)) == 2
    with pytest.raises(q.EmptyPartition):
        q.require_partition(feed, "unit_02", dt.date(2025, 4, 1))
    wanted = q.expected_partitions(spark, ["unit_01", "unit_02"], dt.date(2025, 4, 1), dt.date(2025, 4, 2))
    assert as_set(q.missing_partitions(feed, wanted)) == {("unit_01", 2025, 4, 2), ("unit_02", 2025, 4, 1)}


@pytest.mark.parametrize(
    ("now", "status"), [("2025-04-02 10:00:00", "warn"), ("2025-04-01 10:00:00", "pass"), ("2025-04-03 00:00:00", "error")]
)
def test_freshness(rows, now, status):
    assert q.freshness(rows(FEED, ("u", 2025, 4, 1)), now).first()["status"] == status


def test_freshness_of_an_empty_feed(spark, rows):
    assert q.freshness(rows(FEED, ("u", 2025, 4, 1)).limit(0), "2025-04-03 00:00:00").first()["status"] == "error"


def test_contract_violations(rows):
    expected = T.StructType([T.StructField("v", T.StringType())])
    assert q.contract_violations(rows("v int", (1,)), expected) == ["v: int instead of string"]


def test_audit_of_all_feeds(spark, rows):
    root, day = scratch_path(spark, "bronze"), dt.date(2025, 4, 1)
    feed = rows("centro_custo_id string, descricao string, created_at timestamp_ntz, tenant_id string", ("1", "x", None, "unit_01"))
    bronze.write_bronze(bronze.with_partition_day(feed, day), root, "controladoria", "centros_custos")
    odd = rows("departamento_id int, created_at timestamp_ntz, tenant_id string, year int, month int, day int", (1, None, "unit_01", 2025, 4, 1))
    odd.write.partitionBy("tenant_id", "year", "month", "day").parquet(f"{root}/corporativo/departamentos")
    gaps, differences = q.audit_deliveries(spark, root, ["unit_01", "unit_02"], day, day)
    assert gaps.count() == 23 * 2 - 2
    assert as_set(gaps.filter("table = 'centros_custos'").select("tenant_id")) == {("unit_02",)}
    assert differences == {"corporativo.departamentos": ["missing nome string", "departamento_id: int instead of string"]}


def test_contract_of_every_file(spark, rows):
    """One bad delivery among good ones, without rows, and one that is no Parquet."""
    root, path = scratch_path(spark, "bronze"), "corporativo/departamentos"
    ddl = "departamento_id {}, nome string, created_at timestamp_ntz, tenant_id string, year int, month int, day int"
    good = rows(ddl.format("string"), *[("1", "x", None, t, 2025, 4, d) for t in ("unit_01", "unit_02") for d in (1, 2, 3)])
    good.write.partitionBy("tenant_id", "year", "month", "day").parquet(f"{root}/{path}")
    bad = rows(ddl.format("int"), (1, "x", None, "unit_02", 2025, 4, 2)).drop("tenant_id", "year", "month", "day")
    bad.limit(0).write.mode("append").parquet(f"{root}/{path}/tenant_id=unit_02/year=2025/month=4/day=2")
    with open(f"{root}/{path}/tenant_id=unit_01/year=2025/month=4/day=3/torn.parquet", "wb") as f:
        f.write(b"PAR1")
    got = q.contract_differences(spark, root, "corporativo", "departamentos").collect()
    assert sorted((r["tenant_id"], r["day"], r["difference"].split(": ")[0]) for r in got) == [
        ("unit_01", 3, "unreadable"), ("unit_02", 2, "departamento_id"),
    ]
    _, found = q.audit_deliveries(spark, root, ["unit_01", "unit_02"], dt.date(2025, 4, 1), dt.date(2025, 4, 2))
    assert found == {"corporativo.departamentos": ["departamento_id: int instead of string"]}


def test_source_checks(rows):
    feed = rows("tenant_id string, cliente_id string", ("u", None), (None, "1"), ("u", "2"))
    [(name, failing)] = checks.failing_rows("clientes", {"clientes": feed})
    assert name == "clientes.not_null" and as_set(failing) == {("cliente_id", 1), ("tenant_id", 1)}
