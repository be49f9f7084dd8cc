from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_of
from stratalake.plans import silver
from stratalake.plans.build import build_layers, check_results
from stratalake.plans.catalogue import Models
from stratalake.session import shuffle_partitions_for
from stratalake.sources.tables import partition_columns
from workload.feeds import Feeds

SF_DIR = "/root/testdata/sf0.001"
D, TS = Decimal, dt.datetime

ACCOUNTING = (
    "silver_dw_plano_contas", "silver_dw_lancamentos", "silver_dw_empresas", "silver_dw_centros_custos",
    "dim_plano_contas", "dim_empresas", "dim_centros_custos", "fct_lancamentos", "dre_contabil", "dre_gerencial",
)


@pytest.fixture
def accounting(rows):
    entry = (
        "tenant_id string, lancamento_id string, plano_conta_id string, cd_tipo_lancamento string,"
        "dt_competencia timestamp_ntz, vlr_lancamento decimal(18,2), historico string, created_at timestamp_ntz"
    )
    static = {
        "plano_contas": rows(
            "tenant_id string, plano_conta_id string, codigo string, descricao string, tipo string, created_at timestamp_ntz",
            ("u", "r", "1", "d", "receita", TS(2025, 1, 1)),
        ),
        "empresas": rows(
            "tenant_id string, empresa_id string, razao_social string, documento string, created_at timestamp_ntz",
            ("u", "e", "x", "1", TS(2025, 1, 1)),
        ),
        "centros_custos": rows(
            "tenant_id string, centro_custo_id string, nome string, created_at timestamp_ntz",
            ("u", "c", "x", TS(2025, 1, 1)),
        ),
    }
    month = TS(2025, 1, 1)
    first = [("u", "1", "r", "credito", month, D(10), None, TS(2025, 1, 2)), ("u", "2", "r", "debito", month, D(3), None, TS(2025, 1, 2))]
    late = [("u", "3", "r", "credito", month, D(5), None, TS(2025, 1, 20))]
    return (
        {**static, "lancamentos": rows(entry, *first)},
        {**static, "lancamentos": rows(entry, *first, *late)},
    )


def test_incremental_run_equals_a_full_build(spark, lake, accounting):
    before, after = accounting
    build_layers(spark, before, lake, ACCOUNTING, now="2025-01-03 00:00:00")
    built = build_layers(spark, after, lake, ACCOUNTING, full_refresh=False, now="2025-01-21 00:00:00")
    assert as_set(built["dre_contabil"].select("vlr_total")) == {(D("12.00"),)}
    assert as_set(built["dre_gerencial"].select("ds_categoria", "vlr_categoria")) == {("RECEITA_BRUTA", D("12.00"))}
    whole = Models(spark, after)
    for name in ACCOUNTING:
        a, b = built[name].drop("_dbt_loaded_at"), whole[name].drop("_dbt_loaded_at")
        assert as_set(a.select(sorted(a.columns))) == as_set(b.select(sorted(b.columns))), name


def test_month_partitions_give_the_same_tables(spark, lake, accounting):
    before, after = accounting
    options = {"month_partitions": True}
    build_layers(spark, before, lake, ACCOUNTING, now="2025-01-03 00:00:00", **options)
    built = build_layers(
        spark, after, lake, ACCOUNTING, full_refresh=False, now="2025-01-21 00:00:00", **options
    )
    assert partition_columns(spark, lake.name("gold", "fct_lancamentos")) == ["tenant_id", "_mes"]
    assert "_mes" not in built["fct_lancamentos"].columns
    assert as_set(built["dre_contabil"].select("vlr_total")) == {(D("12.00"),)}
    assert built["silver_dw_lancamentos"].count() == 3


def test_incremental_run_opens_recent_deliveries_only(rows):
    feed = rows(
        "tenant_id string, cliente_id string, nome string, documento string, email string, cidade string,"
        "uf string, created_at timestamp_ntz, updated_at timestamp_ntz, year int, month int, day int",
        ("u", "1", "a", "", "", "", "", None, TS(2025, 1, 9), 2025, 1, 9),
        ("u", "2", "b", "", "", "", "", None, TS(2025, 1, 9), 2025, 1, 1),  # cannot happen: delivered before
    )
    run = lambda **kw: as_set(
        silver.build("silver_dw_clientes", {"clientes": feed}, now="2025-01-10 00:00:00", **kw).select("cliente_id")
    )
    since = dt.date(2025, 1, 8)
    assert run(incremental=True, delivered_from=since) == {("1",)}
    assert run(incremental=True) == run(delivered_from=since) == {("1",), ("2",)}


def test_same_run_twice_changes_nothing(spark, lake, accounting):
    _, after = accounting
    for full in (True, False, False):
        built = build_layers(spark, after, lake, ACCOUNTING, full_refresh=full, now="2025-01-21 00:00:00")
    assert built["fct_lancamentos"].count() == 3
    failures = check_results(built, ACCOUNTING).filter("failures > 0")
    assert failures.count() == 0


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, Feeds(spark, SF_DIR), as_of="2000-01-01")


def scans(df) -> list[str]:
    return [x for x in plan_of(df).split("== Physical Plan ==")[1].splitlines() if "FileScan" in x]


def test_unused_columns_are_not_read(models):
    """A dimension that only proves existence is read by key; unused measures are pruned."""
    orders = models["fct_ordens_compra"].select("tenant_id", "vlr_total")
    supplier = next(x for x in scans(orders) if "supplier" in x)
    assert "s_acctbal" not in supplier
    sales = models["fct_vendas"].groupBy("ds_status").agg(F.sum("vlr_total"))
    assert not any("l_discount" in x or "o_orderpriority" in x for x in scans(sales))


def test_titles_fact_adds_no_shuffle(models):
    silver_only = plan_of(models["silver_dw_titulos_financeiros"]).count("Exchange")
    assert plan_of(models["fct_titulo_financeiro"]).count("Exchange") == silver_only


def test_ledger_is_aggregated_before_the_fan_out(models):
    plan = plan_of(models["dre_contabil"]).split("== Physical Plan ==")[1]
    assert "partial_sum" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_no_plan_leaves_the_jvm(models):
    for name in models:
        assert "Python" not in plan_of(models[name]), name


def test_slice_prunes_to_one_tenant_directory(spark, lake, models):
    lake.write(models["silver_dw_vendas"], "silver", "vendas")
    one = lake.table("silver", "vendas").filter("tenant_id = 'unit_01'")
    assert "PartitionFilters: [isnotnull(tenant_id" in plan_of(one)


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(1 << 40) == 4096
    assert shuffle_partitions_for(100 << 40) == 50_000
