from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import as_set, plan_of
from stratalake.session import scratch_path
from stratalake.sources import bronze, conform
from stratalake.sources.contract import DATAMART_OF, REGISTRY, data_schema, full_schema
from stratalake.sources.tables import compact, overwrite_partitions

SUPPLIERS = "fornecedor_id string, nome string, documento string, created_at timestamp_ntz, tenant_id string"


def supplier(key, tenant, name="n", day=1):
    return (key, name, None, dt.datetime(2025, 4, day), tenant)


def test_registry_is_complete():
    assert len(REGISTRY) == 23
    assert len({datamart for datamart, _ in REGISTRY}) == 8
    assert DATAMART_OF["vendas"] == "comercial"


def test_money_is_decimal():
    money = [f for s in REGISTRY.values() for f in s if f.name.startswith(("vlr_", "preco"))]
    assert money and all(f.dataType == T.DecimalType(18, 2) for f in money)
    assert data_schema("comercial", "itens_pedido")["qtd_vendida"].dataType == T.DecimalType(18, 4)


def test_unknown_table():
    with pytest.raises(KeyError):
        data_schema("comercial", "nope")


def test_round_trip_layout_and_redelivery(spark, rows):
    root = scratch_path(spark, "bronze")
    first = rows(SUPPLIERS, supplier("1", "unit_01"), supplier("2", "unit_02"), supplier("3", "unit_01", day=2))
    day = F.col("created_at").cast("date")
    bronze.write_bronze(bronze.with_partition_day(first, day), root, "suprimentos", "fornecedores")
    again = rows(SUPPLIERS, supplier("1", "unit_01", "fixed"))
    for _ in range(2):
        bronze.write_bronze(bronze.with_partition_day(again, day), root, "suprimentos", "fornecedores")
    back = bronze.read_bronze(spark, root, "suprimentos", "fornecedores")
    assert back.schema == full_schema("suprimentos", "fornecedores")
    assert as_set(back.select("fornecedor_id", "nome", "tenant_id", "year", "month", "day")) == {
        ("1", "fixed", "unit_01", 2025, 4, 1),
        ("2", "n", "unit_02", 2025, 4, 1),
        ("3", "n", "unit_01", 2025, 4, 2),
    }
    files = [r[0] for r in back.select("_metadata.file_path").distinct().collect()]
    assert any("suprimentos/fornecedores/tenant_id=unit_02/year=2025/month=4/day=1/" in f for f in files)


def test_pruning_reaches_the_directory_level(spark, rows):
    root = scratch_path(spark, "bronze")
    data = rows(SUPPLIERS, *[supplier(str(d), t, day=d) for d in (1, 2, 3) for t in ("unit_01", "unit_02")])
    bronze.write_bronze(
        bronze.with_partition_day(data, F.col("created_at").cast("date")), root, "suprimentos", "fornecedores"
    )
    feed = bronze.read_bronze(spark, root, "suprimentos", "fornecedores")
    pruned = bronze.prune(feed, ["unit_02"], dt.date(2025, 4, 2), dt.date(2025, 4, 3))
    assert as_set(pruned.select("fornecedor_id")) == {("2",), ("3",)}
    scan = next(x for x in plan_of(pruned).splitlines() if "FileScan" in x)
    assert "PartitionFilters: [" in scan and "unit_02" in scan and "year" in scan
    assert len(pruned.inputFiles()) == 6 and len({r[0] for r in pruned.select("_metadata.file_path").collect()}) == 2


def test_register_views_and_external_tables(spark, rows):
    root = scratch_path(spark, "bronze")
    data = bronze.with_partition_day(rows(SUPPLIERS, supplier("1", "unit_01")), dt.date(2025, 4, 1))
    bronze.write_bronze(data, root, "suprimentos", "fornecedores")
    assert bronze.register_bronze(spark, root, "b1") == ["b1_fornecedores"]
    assert spark.sql("select count(*) from b1_fornecedores where tenant_id = 'unit_01'").first()[0] == 1
    assert bronze.register_external(spark, root, "b2") == ["b2.fornecedores"]
    assert spark.table("b2.fornecedores").filter("year = 2025").count() == 1


def test_unify_keeps_tenant_and_fills_missing_columns(rows):
    a = rows("id string, doc string", ("1", "x"))
    b = rows("id string, cnpj string", ("1", "y"))
    got = bronze.unify_tenants({"unit_01": a, "unit_02": b})
    assert as_set(got.select("tenant_id", "id", "doc", "cnpj")) == {
        ("unit_01", "1", "x", None),
        ("unit_02", "1", None, "y"),
    }


def test_conform_splits_debit_and_credit(rows):
    raw = rows(
        "tenant_id string, lancamento_id string, conta_id string, dt_lancamento timestamp_ntz,"
        "vlr_debito decimal(18,2), vlr_credito decimal(18,2), historico string, created_at timestamp_ntz",
        ("u", "1", "c", None, Decimal("5.00"), None, "h", None),
        ("u", "2", "c", None, Decimal("0.00"), Decimal("7.00"), None, None),
        ("u", "3", "c", None, None, None, None, None),
    )
    got = conform.conform_feed("lancamentos", raw)
    assert as_set(got.select("lancamento_id", "plano_conta_id", "cd_tipo_lancamento", "vlr_lancamento")) == {
        ("1", "c", "DEBITO", Decimal("5.00")),
        ("2", "c", "CREDITO", Decimal("7.00")),
        ("3", "c", None, None),
    }


def test_conform_covers_every_raw_contract(spark):
    for table in conform.SILVER_INPUT:
        raw = spark.createDataFrame([], full_schema(DATAMART_OF[table], table))
        got = conform.conform_feed(table, raw)
        assert got.columns[-3:] == ["year", "month", "day"]
        got = got.drop("year", "month", "day")
        assert conform.schema_differences(got.schema, conform.SILVER_INPUT[table][0]) == []


def test_settlement_side_from_the_title_id(rows):
    raw = rows(
        "tenant_id string, baixa_id string, titulo_id string, vlr_baixa decimal(18,2), dt_baixa timestamp_ntz,"
        "created_at timestamp_ntz",
        ("u", "b1", "TPG-u-1", Decimal(1), None, None),
        ("u", "b2", "TRC-u-1", Decimal(1), None, None),
    )
    got = conform.conform_feed("baixas", raw)
    assert as_set(got.select("titulo_id", "tipo_titulo")) == {("TPG-u-1", "PAGAR"), ("TRC-u-1", "RECEBER")}


def test_conform_requires_a_source(rows):
    schema = T.StructType([T.StructField("a", T.StringType())])
    with pytest.raises(conform.ContractError):
        conform.conform(rows("x string", ("1",)), {"a": ("b", "c")}, schema, required=["a"])


def test_schema_differences(rows):
    want = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    assert conform.schema_differences(rows("a int, c string", (1, "x")).schema, want) == [
        "missing b int",
        "unexpected c string",
        "a: int instead of string",
    ]


def test_layers_resolve_names_literally(lake, rows):
    lake.prefix = ""
    assert lake.database("silver") == "silver_dev"


def test_compact_keeps_rows_and_reduces_files(spark, lake, rows):
    data = rows("id int, tenant_id string", *[(i, f"unit_0{i % 2 + 1}") for i in range(40)])
    name = lake.name("silver", "t")
    data.repartition(4).write.partitionBy("tenant_id").saveAsTable(name)
    compact(spark, name, "tenant_id = 'unit_01'", 1)
    table = spark.table(name)
    assert as_set(table.select("id")) == {(i,) for i in range(40)}
    per_tenant = dict(
        table.groupBy("tenant_id").agg(F.count_distinct("_metadata.file_path")).collect()
    )
    assert per_tenant["unit_01"] == 1 and per_tenant["unit_02"] > 1


def test_full_rebuild_removes_old_partitions(spark, lake, rows):
    lake.write(rows("id int, tenant_id string", (1, "a"), (2, "b")), "silver", "t")
    lake.write(rows("id int, tenant_id string", (9, "b")), "silver", "t")
    assert as_set(lake.table("silver", "t")) == {(9, "b")}


def test_partition_overwrite_of_a_foreign_table(spark, lake, rows):
    name = lake.name("silver", "f")
    rows("id int, tenant_id string", (1, "a"), (2, "b")).write.partitionBy("tenant_id").saveAsTable(name)
    overwrite_partitions(rows("id int, tenant_id string", (9, "b")), name)
    assert as_set(spark.table(name)) == {(1, "a"), (9, "b")}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_partition_overwrite_keeps_the_others(spark, lake, rows):
    name = lake.name("silver", "t")
    lake.write(rows("id int, tenant_id string", (1, "a"), (2, "b")), "silver", "t")
    overwrite_partitions(rows("id int, tenant_id string", (9, "b")), name)
    assert as_set(spark.table(name)) == {(1, "a"), (9, "b")}
