from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from stratalake.plans import analytics, dims, facts, silver
from stratalake.plans.catalogue import BUILD_ORDER, LAYER_OF

D = Decimal
TS = dt.datetime


def test_inventory():
    layers = list(LAYER_OF.values())
    assert (layers.count("silver"), layers.count("gold"), layers.count("platinum")) == (21, 18, 6)
    assert sorted(n for group in BUILD_ORDER for n in group) == sorted(LAYER_OF)


CUSTOMERS = (
    "tenant_id string, cliente_id string, nome string, documento string, email string, cidade string,"
    "uf string, created_at timestamp_ntz, updated_at timestamp_ntz"
)


def test_customers_are_cleaned(rows):
    at = TS(2025, 1, 1)
    feed = rows(
        CUSTOMERS,
        ("unit_01", "C1", "\t ana ", None, " A@B.c ", "rio ", "rj", at, at),
        ("unit_01", "C1", "older", "1", "x", "y", "z", at, TS(2024, 1, 1)),
        ("unit_02", "C1", "bia", "1.2/3", None, None, None, at, at),
        ("unit_01", None, "no key", "1", "x", "y", "z", at, at),
    )
    got = silver.build("silver_dw_clientes", {"clientes": feed})
    assert got.columns[-1] == "_dbt_loaded_at"
    assert as_set(got.select("tenant_id", "cliente_id", "nm_cliente", "nr_documento", "ds_email", "nm_cidade")) == {
        ("unit_01", "C1", "ANA", "", "a@b.c", "RIO"),
        ("unit_02", "C1", "BIA", "123", None, None),
    }
    keys = dims.plain_dimension("dim_clientes", {"silver_dw_clientes": got}).select("cliente_sk")
    assert keys.distinct().count() == 2


def test_incremental_customers_use_the_lookback(rows):
    feed = rows(
        CUSTOMERS,
        ("u", "1", "a", "", "", "", "", None, TS(2025, 1, 8)),
        ("u", "2", "b", "", "", "", "", None, TS(2025, 1, 7, 23)),
        ("u", "3", "c", "", "", "", "", None, None),
    )
    got = silver.build("silver_dw_clientes", {"clientes": feed}, incremental=True, now="2025-01-10 00:00:00")
    assert as_set(got.select("cliente_id")) == {("1",)}


TITLE = "tenant_id string, titulo_id string, {p} string, dt_emissao timestamp_ntz, dt_vencimento timestamp_ntz, vlr_titulo decimal(18,2), created_at timestamp_ntz"
SETTLED = "tenant_id string, titulo_id string, tipo_titulo string, dt_baixa timestamp_ntz, vlr_baixado decimal(18,2)"


@pytest.fixture
def finance(rows):
    """Today is 2025-01-10."""
    old, new = TS(2024, 12, 1), TS(2025, 1, 9)
    return {
        "titulos_pagar": rows(
            TITLE.format(p="fornecedor_id"),
            ("u", "1", "F", old, TS(2025, 1, 9, 10), D("10.00"), new),
            ("u", "2", "F", old, TS(2025, 1, 20), D("10.00"), old),
        ),
        "titulos_receber": rows(
            TITLE.format(p="cliente_id"),
            ("u", "1", "C", old, TS(2025, 1, 1), D("99.00"), old),
            ("u", "3", "C", old, TS(2025, 1, 7), D("5.00"), old),
        ),
        "baixas": rows(
            SETTLED,
            ("u", "1", "RECEBER", TS(2025, 1, 8), D("1.00")),
            ("u", "1", "RECEBER", TS(2025, 1, 9), D("2.50")),
            ("x", "3", "RECEBER", TS(2025, 1, 9), D("2.50")),
        ),
    }


NOW = "2025-01-10 00:00:00"


def test_titles_union_and_settlements(finance):
    got = silver.finance_titles(finance)
    assert as_set(got.select("titulo_id", "tipo_titulo", "entidade_id", "dt_baixa", "vlr_baixado")) == {
        ("1", "PAGAR", "F", None, D("0.00")),
        ("2", "PAGAR", "F", None, D("0.00")),
        ("1", "RECEBER", "C", TS(2025, 1, 9), D("3.50")),
        ("3", "RECEBER", "C", None, D("0.00")),
    }


def test_late_settlement_selects_its_old_title(finance):
    keys = lambda df: as_set(df.select("titulo_id", "tipo_titulo"))
    original = silver.finance_titles(finance, incremental=True, now=NOW, follow_settlements=False)
    assert keys(original) == {("1", "PAGAR")}
    assert keys(silver.finance_titles(finance, incremental=True, now=NOW)) == {("1", "PAGAR"), ("1", "RECEBER")}


def test_title_state_and_complete_days(finance):
    got = facts.titles({silver.TITLES: silver.finance_titles(finance)}, as_of="2025-01-10")
    assert as_set(got.select("titulo_id", "tipo_titulo", "ds_situacao_titulo", "nr_dias_atraso", "data_id")) == {
        ("1", "PAGAR", "VENCIDO", 0, 20250109),  # due yesterday at 10:00
        ("2", "PAGAR", "EM_ABERTO", 0, 20250120),
        ("1", "RECEBER", "LIQUIDADO", 0, 20250101),  # partly paid counts as settled
        ("3", "RECEBER", "VENCIDO", 3, 20250107),
    }


def test_open_titles_are_evaluated_again(finance):
    rows = {silver.TITLES: silver.finance_titles(finance)}
    stored = facts.titles(rows, as_of="2025-01-05")
    later = facts.titles(rows, incremental=True, now="2025-02-01 00:00:00", as_of="2025-02-01")
    assert later.count() == 0
    later = facts.build(
        "fct_titulo_financeiro", rows, incremental=True, now="2025-02-01 00:00:00", as_of="2025-02-01", stored=stored
    )
    assert as_set(later.select("titulo_id", "tipo_titulo", "ds_situacao_titulo")) == {
        ("1", "PAGAR", "VENCIDO"), ("2", "PAGAR", "VENCIDO"), ("3", "RECEBER", "VENCIDO"),
    }


def test_sales_hash_unchecked_foreign_keys(rows):
    t = {
        "silver_dw_itens_pedido": rows(
            "tenant_id string, item_id string, venda_id string, produto_id string, qtd_vendida decimal(18,4),"
            "vlr_unitario decimal(18,2), vlr_total decimal(18,2), created_at timestamp_ntz",
            ("u", "i1", "v1", None, D(1), D(2), D(2), None),
            ("w", "i1", "v1", "p", D(1), D(2), D(2), None),
        ),
        "silver_dw_vendas": rows(
            "tenant_id string, venda_id string, cliente_id string, vendedor_id string, ds_status string,"
            "dt_venda timestamp_ntz",
            ("u", "v1", "c", "s", "FATURADA", TS(2025, 1, 1)),
        ),
    }
    got = facts.sales(t).collect()
    assert [r.tenant_id for r in got] == ["u"] and len(got[0].produto_sk) == 32


def test_shipment_delay(rows):
    day = dt.date(2025, 1, 10)
    base = ("v", "t", day, day)
    exp = rows(
        "tenant_id string, expedicao_id string, venda_id string, transportadora_id string, dt_expedicao date,"
        "dt_entrega_prevista date, dt_entrega_realizada date, ds_status string, updated_at timestamp_ntz,"
        "created_at timestamp_ntz",
        ("u", "early", *base, dt.date(2025, 1, 8), "", None, None),
        ("u", "late", *base, dt.date(2025, 1, 13), "", None, None),
        ("u", "open", *base, None, "", None, None),
        ("u", "unknown carrier", "v", "x", day, day, None, "", None, None),
    )
    carriers = rows("tenant_id string, transportadora_id string", ("u", "t"))
    got = facts.shipments({"silver_dw_expedicao": exp, "silver_dw_transportadoras": carriers})
    assert as_set(got.select("expedicao_id", "nr_dias_atraso")) == {("early", -2), ("late", 3), ("open", None)}


def test_production_days_of_running_orders(rows):
    orders = rows(
        "tenant_id string, ordem_producao_id string, produto_id string, qt_produzida decimal(18,4),"
        "dt_inicio date, dt_fim date, ds_status string, created_at timestamp_ntz",
        ("u", "done", "p", D(1), dt.date(2025, 1, 1), dt.date(2025, 1, 4), "", None),
        ("u", "running", "p", D(1), dt.date(2025, 1, 1), None, "", None),
    )
    products = rows("tenant_id string, produto_id string, produto_sk string", ("u", "p", "k"))
    got = facts.production_orders({"silver_dw_ordens_producao": orders, "dim_produtos": products}, as_of="2025-01-10")
    assert as_set(got.select("ordem_producao_id", "nr_dias_producao")) == {("done", 3), ("running", 9)}


@pytest.fixture
def ledger(rows):
    entries = rows(
        "tenant_id string, lancamento_id string, plano_conta_id string, cd_tipo_lancamento string,"
        "dt_competencia date, vlr_lancamento decimal(18,2), ds_historico string, created_at timestamp_ntz",
        ("u", "1", "r", "CREDITO", dt.date(2025, 1, 1), D("10.00"), "", TS(2025, 1, 1)),
        ("u", "2", "r", "DEBITO", dt.date(2025, 1, 1), D("4.00"), "", TS(2025, 1, 9)),
        ("u", "3", "r", None, dt.date(2025, 2, 1), D("1.00"), "", TS(2025, 1, 1)),
        ("u", "4", "x", "CREDITO", dt.date(2025, 1, 1), D("7.00"), "", TS(2025, 1, 1)),
        ("u", "5", "unknown account", "CREDITO", dt.date(2025, 1, 1), D("7.00"), "", TS(2025, 1, 1)),
    )
    accounts = rows(
        "tenant_id string, plano_conta_id string, plano_conta_sk string, cd_tipo_conta string",
        ("u", "r", "k1", "RECEITA"), ("u", "x", "k2", "PATRIMONIO"),
    )
    t = {"silver_dw_lancamentos": entries, "dim_plano_contas": accounts}
    t["fct_lancamentos"] = facts.ledger_entries(t)
    t["dim_empresas"] = rows("tenant_id string, empresa_id string", ("u", "e1"), ("u", "e2"), ("w", "e1"))
    t["dim_centros_custos"] = rows(
        "tenant_id string, centro_custo_id string, centro_custo_sk string", ("u", "c1", "k"), ("u", "c2", "k"), ("u", "c3", "k")
    )
    t["dre_contabil"] = analytics.accounting_statement(t, buckets=3)
    return t


def test_ledger_sign(ledger):
    assert as_set(ledger["fct_lancamentos"].select("lancamento_id", "vlr_final")) == {
        ("1", D("10.00")), ("2", D("-4.00")), ("3", D("-1.00")), ("4", D("7.00")),
    }


def test_statement_repeats_totals_for_every_pair(ledger):
    got = ledger["dre_contabil"]
    assert got.count() == 3 * 2 * 3
    pairs = got.filter("cd_tipo_conta = 'RECEITA' and dt_competencia = '2025-01-01'")
    assert pairs.select("empresa_id", "centro_custo_id").distinct().count() == 6
    assert as_set(pairs.select("vlr_total")) == {(D("6.00"),)}


def test_unknown_account_types_fall_into_the_default_category(ledger):
    got = analytics.managerial_statement(ledger)
    assert as_set(got.select("ds_categoria").distinct()) == {("RECEITA_BRUTA",), ("OUTROS",)}
    assert as_set(
        analytics.group_statement(ledger).filter("cd_tipo_conta = 'RECEITA'").select("dt_competencia", "vlr_total")
    ) == {(dt.date(2025, 1, 1), D("6.00")), (dt.date(2025, 2, 1), D("-1.00"))}


def test_incremental_statement_recomputes_whole_groups(ledger):
    now = "2025-01-10 00:00:00"
    full = analytics.accounting_statement(ledger, "affected", now).select("vlr_total")
    assert as_set(full) == {(D("6.00"),)}
    partial = analytics.accounting_statement(ledger, "recent_only", now).select("vlr_total")
    assert as_set(partial) == {(D("-4.00"),)}  # what a merge of recent sums would store
    with pytest.raises(ValueError):
        analytics.accounting_statement(ledger, "nope")


def test_slice_drops_the_technical_key(ledger):
    got = analytics.tenant_slice(ledger["dre_contabil"], "u")
    assert "dre_contabil_sk" not in got.columns and got.count() == 18
    assert analytics.tenant_slice(ledger["dre_contabil"], "w").count() == 0


def test_missing_department(rows):
    staff = rows(
        "tenant_id string, funcionario_id string, nm_funcionario string, departamento_id string, ds_cargo string,"
        "dt_admissao date, created_at timestamp_ntz",
        ("u", "1", "A", "d", "", None, None), ("u", "2", "B", None, "", None, None), ("w", "3", "C", "d", "", None, None),
    )
    departments = rows("tenant_id string, departamento_id string, nm_departamento string", ("u", "d", "RH"))
    got = dims.employees({"silver_dw_funcionarios": staff, "silver_dw_departamentos": departments})
    assert as_set(got.select("funcionario_id", "nm_departamento")) == {
        ("1", "RH"), ("2", "NAO_INFORMADO"), ("3", "NAO_INFORMADO"),
    }


def test_default_calendar(spark):
    days = dims.calendar(spark)
    assert days.count() == 1461
    assert as_set(days.filter("data_id = 20240106").select("nr_dia_semana", "fl_fim_de_semana", "nm_ano_mes")) == {
        (6, True, "2024-01")
    }


def test_overdue_by_customer(rows):
    t = {
        "fct_titulo_financeiro": rows(
            "tenant_id string, entidade_id string, tipo_titulo string, ds_situacao_titulo string,"
            "nr_dias_atraso bigint, vlr_titulo decimal(18,2)",
            ("u", "c", "RECEBER", "VENCIDO", 31, D("1.00")), ("u", "c", "RECEBER", "VENCIDO", 36, D("2.00")),
            ("u", "c", "RECEBER", "VENCIDO", 30, D("9.00")), ("u", "c", "PAGAR", "VENCIDO", 99, D("9.00")),
            ("u", "gone", "RECEBER", "VENCIDO", 40, D("3.00")),
        ),
        "dim_clientes": rows(
            "tenant_id string, cliente_id string, cliente_sk string, nm_cliente string, nr_documento string",
            ("u", "c", "k", "ANA", "1"),
        ),
    }
    got = analytics.overdue_by_customer(t)
    assert as_set(got.select("cliente_id", "nm_cliente", "vlr_inadimplente", "dias_atraso_medio", "qtd_titulos_vencidos")) == {
        ("c", "ANA", D("3.00"), 33, 2), ("gone", None, D("3.00"), 40, 1),
    }
