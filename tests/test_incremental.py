"""Incremental runs against full builds, on the rows that used to differ."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_set
from stratalake.plans.build import build_layers
from stratalake.plans.catalogue import Models
from stratalake.sources import bronze, conform

D, TS = Decimal, dt.datetime
TITLES = ["silver_dw_titulos_financeiros", "fct_titulo_financeiro"]
OLD, DAY1, DAY2 = TS(2025, 1, 1), TS(2025, 1, 20), TS(2025, 1, 21)


def title_feeds(rows, settlements, titles=(("u", "t", OLD),)):
    side = lambda party: rows(
        f"tenant_id string, titulo_id string, {party} string, vlr_titulo decimal(18,2), dt_emissao timestamp_ntz,"
        "dt_vencimento timestamp_ntz, created_at timestamp_ntz",
        *([(t, i, "c", D(100), OLD, OLD, at) for t, i, at in titles] if party == "cliente_id" else []),
    )
    baixas = rows(
        "tenant_id string, titulo_id string, tipo_titulo string, dt_baixa timestamp_ntz, vlr_baixado decimal(18,2),"
        "created_at timestamp_ntz",
        *settlements,
    )
    return {"titulos_pagar": side("fornecedor_id"), "titulos_receber": side("cliente_id"), "baixas": baixas}


def run_two_days(spark, lake, models, first, second, now="2025-01-21 12:00:00"):
    build_layers(spark, first, lake, models, now="2025-01-20 12:00:00", as_of="2025-01-20")
    return build_layers(spark, second, lake, models, full_refresh=False, now=now, as_of="2025-01-21")


def test_second_settlement_of_a_settled_title(spark, lake, rows):
    one, two = ("u", "t", "RECEBER", OLD, D(40), OLD), ("u", "t", "RECEBER", TS(2025, 1, 5), D(60), DAY2)
    built = run_two_days(spark, lake, TITLES, title_feeds(rows, [one]), title_feeds(rows, [one, two]))
    for name in TITLES:
        assert as_set(built[name].select("vlr_baixado", "dt_baixa")) == {(D("100.00"), TS(2025, 1, 5))}


def test_settlement_delivered_late_with_an_old_date(spark, lake, rows):
    late = ("u", "t", "RECEBER", TS(2025, 1, 3), D(100), DAY2)
    built = run_two_days(spark, lake, TITLES, title_feeds(rows, []), title_feeds(rows, [late]))
    assert as_set(built["fct_titulo_financeiro"].select("vlr_baixado", "ds_situacao_titulo")) == {(D("100.00"), "LIQUIDADO")}


def test_repeated_title_keeps_the_latest_in_both_modes(spark, lake, rows):
    feeds = title_feeds(rows, [], [("u", "t", OLD), ("u", "t", DAY2), ("u", "v", OLD)])
    full = Models(spark, feeds)["silver_dw_titulos_financeiros"]
    built = run_two_days(spark, lake, TITLES, title_feeds(rows, []), feeds)
    assert as_set(built[TITLES[0]].select("titulo_id", "created_at")) <= as_set(full.select("titulo_id", "created_at"))
    assert as_set(full.select("titulo_id", "created_at")) == {("t", DAY2), ("v", OLD)}


ENTRY = (
    "tenant_id string, lancamento_id string, plano_conta_id string, cd_tipo_lancamento string,"
    "dt_competencia timestamp_ntz, vlr_lancamento decimal(18,2), historico string, created_at timestamp_ntz"
)
LEDGER = [
    "silver_dw_plano_contas", "silver_dw_lancamentos", "silver_dw_empresas", "silver_dw_centros_custos",
    "dim_plano_contas", "dim_empresas", "dim_centros_custos", "fct_lancamentos", "dre_contabil", "dre_gerencial",
]


def ledger_feeds(rows, entries, companies=(("e", OLD),)):
    return {
        "plano_contas": rows(
            "tenant_id string, plano_conta_id string, codigo string, descricao string, tipo string, created_at timestamp_ntz",
            ("u", "r", "1", "d", "receita", OLD),
        ),
        "empresas": rows(
            "tenant_id string, empresa_id string, razao_social string, documento string, created_at timestamp_ntz",
            *[("u", e, "x", "1", at) for e, at in companies],
        ),
        "centros_custos": rows(
            "tenant_id string, centro_custo_id string, nome string, created_at timestamp_ntz", ("u", "c", "x", OLD)
        ),
        "lancamentos": rows(ENTRY, *[("u", i, "r", "credito", m, D(v), None, at) for i, m, v, at in entries]),
    }


def statements(built):
    columns = ["empresa_id", "cd_tipo_conta", "dt_competencia", "vlr_total"]
    return as_set(built["dre_contabil"].select(*columns)), as_set(built["dre_gerencial"].select("empresa_id", "dt_competencia", "vlr_categoria"))


def test_new_company_without_recent_entries(spark, lake, rows):
    entries = [("1", OLD, 10, OLD)]
    after = ledger_feeds(rows, entries, (("e", OLD), ("e2", DAY2)))
    built = run_two_days(spark, lake, LEDGER, ledger_feeds(rows, entries), after)
    assert {r[0] for r in statements(built)[0]} == {"e", "e2"}
    assert statements(built) == statements(Models(spark, after))


def test_entry_moved_to_another_month_leaves_its_old_group(spark, lake, rows):
    feb = TS(2025, 2, 1)
    after = ledger_feeds(rows, [("1", feb, 10, DAY2), ("2", feb, 1, OLD)])
    built = run_two_days(spark, lake, LEDGER, ledger_feeds(rows, [("1", OLD, 10, OLD), ("2", feb, 1, OLD)]), after)
    assert statements(built)[0] == {("e", "RECEITA", feb.date(), D("11.00"))}
    assert statements(built) == statements(Models(spark, after))


def test_repeated_ledger_key_is_one_row_in_both_modes(spark, lake, rows):
    first = [("1", OLD, 10, OLD), ("1", OLD, 12, TS(2025, 1, 2))]
    built = run_two_days(spark, lake, LEDGER, ledger_feeds(rows, first), ledger_feeds(rows, [*first, ("3", OLD, 5, DAY2)]))
    assert as_set(built["silver_dw_lancamentos"].select("lancamento_id", "vlr_lancamento")) == {("1", D("12.00")), ("3", D("5.00"))}
    assert {r[3] for r in statements(built)[0]} == {D("17.00")}


def test_conform_takes_both_shapes_of_the_ledger(rows):
    day = [("u", "1", "r", "credito", OLD, D(5), None, OLD, 2025, 1, 2)]
    ready = conform.conform_feed("lancamentos", rows(ENTRY + ", year int, month int, day int", *day))
    assert as_set(ready.select("plano_conta_id", "cd_tipo_lancamento", "vlr_lancamento")) == {("r", "credito", D("5.00"))}
    assert bronze.delivered_since(ready, dt.date(2025, 1, 2)).count() == 1
    assert bronze.delivered_since(ready, dt.date(2025, 1, 3)).count() == 0
    with pytest.raises(ValueError, match="delivery day"):
        bronze.delivered_since(ready.drop("day"), dt.date(2025, 1, 3))


def test_conform_refuses_a_feed_without_its_key_or_types(rows):
    with pytest.raises(conform.ContractError, match="lancamento_id"):
        conform.conform_feed("lancamentos", rows("tenant_id string, conta_id string, created_at timestamp_ntz"))
    with pytest.raises(conform.ContractError, match="created_at"):
        conform.conform_feed("empresas", rows("tenant_id string, empresa_id string, razao_social string, documento string, created_at string"))


def test_sides_of_settlements_without_a_prefix(rows):
    title = "tenant_id string, titulo_id string"
    lost = rows(title + ", tipo_titulo string, vlr_baixado int", ("u", "a", None, 1), ("u", "b", None, 2), ("u", "both", None, 3), ("u", "x", None, 4), ("u", "a", "PAGAR", 5))
    got = conform.resolve_sides(lost, rows(title, ("u", "a"), ("u", "both")), rows(title, ("u", "b"), ("u", "both")))
    assert as_set(got.select("tipo_titulo", "vlr_baixado")) == {("PAGAR", 1), ("RECEBER", 2), (None, 3), (None, 4), ("PAGAR", 5)}
    assert conform.unresolved(got).agg(F.sum("vlr_baixado")).first()[0] == 7
