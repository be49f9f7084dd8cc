"""Income statements and the Platinum marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import date_key, surrogate_key
from stratalake.operators.lookback import within_lookback
from stratalake.operators.skew import fan_out
from stratalake.plans.facts import sales
from stratalake.sources.months import by_month, semi_join_events

Tables = Mapping[str, DataFrame]
Now = dt.datetime | str | Column | None

# Account type to managerial category; anything else is the default.
CATEGORY = {
    "RECEITA": "RECEITA_BRUTA",
    "DESPESA": "DESPESA_OPERACIONAL",
    "ATIVO": "ATIVO_CIRCULANTE",
    "PASSIVO": "PASSIVO_CIRCULANTE",
}
OTHER_CATEGORY = "OUTROS"

STATEMENT_KEYS = ("tenant_id", "empresa_id", "centro_custo_id", "cd_tipo_conta", "dt_competencia")
MANAGERIAL_KEYS = ("tenant_id", "empresa_id", "centro_custo_id", "ds_categoria", "dt_competencia")
GROUP = ["tenant_id", "cd_tipo_conta", "dt_competencia"]


def ledger_totals(entries: DataFrame, sign: str = "1") -> DataFrame:
    """Per (tenant, account type, accounting date): the sum, of how many values, and how many entries.

    ``sign`` is 1 or -1 of each row: with the rows that a merge removes and adds, the result is what it changes.
    """
    some = f"case when vlr_final is null then 0 else {sign} end"
    return entries.groupBy(*GROUP).agg(
        F.expr(f"coalesce(sum(vlr_final * {sign}), 0)").cast("decimal(28,2)").alias("vlr_total"),
        F.expr(f"sum({some})").cast("bigint").alias("qtd_valores"),
        F.expr(f"sum({sign})").cast("bigint").alias("qtd_lancamentos"),
    )


def corrected_totals(totals: DataFrame, changes: DataFrame) -> DataFrame:
    """Totals of the groups of ``changes`` after them; groups without an entry left are not there."""
    groups = changes.select(*GROUP)
    same = reduce(and_, [totals[c].eqNullSafe(groups[c]) for c in GROUP])
    both = totals.join(groups, same, "left_semi").unionByName(changes)
    return (
        both.groupBy(*GROUP)
        .agg(
            F.sum("vlr_total").cast("decimal(28,2)").alias("vlr_total"),
            F.sum("qtd_valores").alias("qtd_valores"),
            F.sum("qtd_lancamentos").alias("qtd_lancamentos"),
        )
        .filter("qtd_lancamentos > 0")
    )


def _totals(t: Tables) -> DataFrame:
    """The stored totals where they are up to date, else those of the entries."""
    kept = getattr(t, "ledger_totals", None)
    return ledger_totals(t["fct_lancamentos"]) if kept is None else kept


# the sum of a group without any value is NULL
SHOWN = "case when qtd_valores > 0 then vlr_total end"


def accounting_statement(
    t: Tables,
    incremental: str | None = None,
    now: Now = None,
    buckets: int = 64,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Totals repeated for every (company, cost centre) of the tenant.

    The values are therefore not additive over companies or centres. The ledger
    is reduced to one row per group before the fan-out; the fan-out itself is
    spread over all tasks, because the tenant alone is a key with few values.

    incremental   None: all entries. "affected": recompute in full the groups
                  of ``affected_groups``. "recent_only": sum the recent
                  entries alone (replaces full totals by partial ones when merged;
                  kept for comparison with the original merge).
    groups        with "affected": the groups, if they have been computed already.
    """
    if incremental is None:
        totals = _totals(t)
    elif incremental == "recent_only":
        totals = ledger_totals(t["fct_lancamentos"].filter(within_lookback("created_at", now)))
    elif incremental == "affected":
        groups = affected_groups(t, now) if groups is None else groups
        kept = getattr(t, "ledger_totals", None)
        if kept is None:
            totals = ledger_totals(semi_join_events(by_month(t, "fct_lancamentos"), groups, "dt_competencia"))
        else:
            totals = kept.join(groups, reduce(and_, [kept[c].eqNullSafe(groups[c]) for c in GROUP]), "left_semi")
    else:
        raise ValueError(f"unknown incremental mode {incremental}")
    totals = totals.withColumn("vlr_total", F.expr(SHOWN))
    rows = _for_every_unit(t, totals, ["cd_tipo_conta", "dt_competencia"], buckets)
    return rows.select(
        surrogate_key(*STATEMENT_KEYS).alias("dre_contabil_sk"),
        "tenant_id",
        "empresa_id",
        "centro_custo_id",
        "centro_custo_sk",
        "cd_tipo_conta",
        "dt_competencia",
        date_key("dt_competencia").alias("data_id"),
        F.col("vlr_total").cast("decimal(18,2)").alias("vlr_total"),
    )


def statement_units(t: Tables) -> DataFrame:
    """Every (company, cost centre) of a tenant: a row of the statement for each."""
    companies = t["dim_empresas"].select("tenant_id", "empresa_id")
    return companies.join(t["dim_centros_custos"].select("tenant_id", "centro_custo_id", "centro_custo_sk"), "tenant_id")


def _for_every_unit(t: Tables, totals: DataFrame, spread_by: list[str], buckets: int = 64) -> DataFrame:
    """``totals`` repeated for every (company, cost centre) of their tenant."""
    return fan_out(totals, statement_units(t), ["tenant_id"], spread_by, buckets)


def affected_groups(t: Tables, now: Now = None) -> DataFrame:
    """Groups of the statement with a recent entry."""
    return t["fct_lancamentos"].filter(within_lookback("created_at", now)).select(*GROUP).distinct()


def changed_units(have: DataFrame, want: DataFrame) -> DataFrame:
    """Tenants whose list of (company, cost centre) is not what it was."""
    have = have.select(*want.columns)
    return have.exceptAll(want).union(want.exceptAll(have)).select("tenant_id").distinct()


def category(account_type: Column | str) -> Column:
    c = F.col(account_type) if isinstance(account_type, str) else account_type
    chain = None
    for kind, label in CATEGORY.items():
        chain = F.when(c == kind, label) if chain is None else chain.when(c == kind, label)
    return chain.otherwise(OTHER_CATEGORY)


def managerial_statement(t: Tables) -> DataFrame:
    """Accounting statement summed by category.

    The value depends on neither company nor cost centre, so the totals are summed
    by category first, a few rows for each tenant and day, and repeated afterwards.
    """
    by_category = _totals(t).withColumn("vlr_total", F.expr(SHOWN)).withColumn("ds_categoria", category("cd_tipo_conta"))
    totals = by_category.groupBy("tenant_id", "ds_categoria", "dt_competencia").agg(
        # each part as the accounting statement shows it
        F.sum(F.col("vlr_total").cast("decimal(18,2)")).alias("vlr_categoria")
    )
    rows = _for_every_unit(t, totals, ["ds_categoria", "dt_competencia"])
    return rows.select(
        surrogate_key(*MANAGERIAL_KEYS).alias("dre_gerencial_sk"),
        "tenant_id",
        "empresa_id",
        "centro_custo_id",
        "centro_custo_sk",
        "ds_categoria",
        "dt_competencia",
        date_key("dt_competencia").alias("data_id"),
        F.col("vlr_categoria").cast("decimal(18,2)").alias("vlr_categoria"),
    )


def group_statement(t: Tables) -> DataFrame:
    """Consolidation over all tenants, from the totals before the fan-out."""
    return (
        t["fct_lancamentos"]
        .groupBy("cd_tipo_conta", "dt_competencia")
        .agg(F.sum("vlr_final").cast("decimal(18,2)").alias("vlr_total"))
    )


def overdue_titles(t: Tables) -> DataFrame:
    return (
        t["fct_titulo_financeiro"]
        .filter(F.col("ds_situacao_titulo") == "VENCIDO")
        .select(
            "tenant_id",
            "titulo_id",
            "tipo_titulo",
            "entidade_id",
            "dt_vencimento",
            "vlr_titulo",
            "nr_dias_atraso",
            "data_id",
        )
    )


def tenant_slice(df: DataFrame, tenant: str) -> DataFrame:
    """One tenant of a statement, without its technical key; prunes to the tenant's partition."""
    technical = [c for c in df.columns if c in ("dre_contabil_sk", "dre_gerencial_sk")]
    return df.filter(F.col("tenant_id") == tenant).drop(*technical)


def product_catalogue(t: Tables) -> DataFrame:
    return t["dim_produtos"].select(
        "tenant_id", "produto_id", "dsc_produto", "nm_categoria", "vlr_preco_unitario", "created_at"
    )


def overdue_by_customer(t: Tables, min_days: int = 30) -> DataFrame:
    """Receivables late by more than ``min_days``, per customer, with the customer's name.

    The titles are summed per customer before the customer dimension is joined.
    """
    late = t["fct_titulo_financeiro"].filter(
        (F.col("ds_situacao_titulo") == "VENCIDO")
        & (F.col("tipo_titulo") == "RECEBER")
        & (F.col("nr_dias_atraso") > min_days)
    )
    totals = late.groupBy("tenant_id", F.col("entidade_id").alias("cliente_id")).agg(
        F.sum("vlr_titulo").cast("decimal(18,2)").alias("vlr_inadimplente"),
        F.expr("sum(nr_dias_atraso) div count(*)").alias("dias_atraso_medio"),
        F.count("*").alias("qtd_titulos_vencidos"),
    )
    customers = t["dim_clientes"].select(
        "tenant_id", "cliente_id", "cliente_sk", "nm_cliente", "nr_documento"
    )
    return totals.join(customers, ["tenant_id", "cliente_id"], "left").select(
        "tenant_id",
        "cliente_id",
        "cliente_sk",
        "nm_cliente",
        "nr_documento",
        "vlr_inadimplente",
        "dias_atraso_medio",
        "qtd_titulos_vencidos",
    )


def enriched_sales(t: Tables) -> DataFrame:
    """Sales lines with customer, product, seller, branch company and calendar attributes.

    Left joins: a line whose dimension row is missing stays, with NULL attributes. The
    natural keys are joined, which are shorter than their hashes; these are made of the
    natural keys after the joins, as the fact does, because hashes do not compress in a shuffle.
    Where the fact is not stored, customers are joined with its sales, which are fewer than
    its lines, and products with its lines before these carry anything of their sale.
    """
    calendar = t["dim_calendrio"].select("data_id", "nm_ano_mes", "nr_trimestre", "fl_fim_de_semana")
    sellers = t["dim_vendedores"].select("tenant_id", "vendedor_id", "nm_vendedor", "filial_id")
    products = t["dim_produtos"].select("tenant_id", "produto_id", "dsc_produto", "nm_categoria")
    customers = t["dim_clientes"].select("tenant_id", "cliente_id", "nm_cliente", "cd_uf")
    companies = t["dim_empresas"].select(
        "tenant_id", F.col("empresa_id").alias("filial_id"), "empresa_sk", "nm_empresa"
    )

    def with_customer(rows: DataFrame) -> DataFrame:
        return rows.join(customers, ["tenant_id", "cliente_id"], "left")

    def with_product(rows: DataFrame) -> DataFrame:
        return rows.join(products, ["tenant_id", "produto_id"], "left")

    if "fct_vendas" in getattr(t, "stored", t):
        lines = with_product(with_customer(t["fct_vendas"]))
    else:
        lines = sales(t, of_sale=with_customer, of_line=with_product)
    joined = (
        lines.join(calendar, "data_id", "left")
        .join(sellers, ["tenant_id", "vendedor_id"], "left")
        .join(companies, ["tenant_id", "filial_id"], "left")
    )
    return joined.select(
        "tenant_id",
        "item_id",
        "venda_id",
        *[surrogate_key("tenant_id", f"{of}_id").alias(f"{of}_sk") for of in ("cliente", "produto", "vendedor")],
        "data_id",
        "ds_status",
        "qtd_vendida",
        "vlr_total",
        "nm_ano_mes",
        "nr_trimestre",
        "fl_fim_de_semana",
        "nm_vendedor",
        "filial_id",
        "dsc_produto",
        "nm_categoria",
        "nm_cliente",
        "cd_uf",
        "empresa_sk",
        "nm_empresa",
    )


# Platinum model -> (statement, tenant)
SLICES = {
    "dre_contabil_unit_01": ("dre_contabil", "unit_01"),
    "dre_contabil_unit_02": ("dre_contabil", "unit_02"),
    "dre_gerencial_unit_01": ("dre_gerencial", "unit_01"),
    "dre_gerencial_unit_02": ("dre_gerencial", "unit_02"),
}


def build_platinum(name: str, t: Tables) -> DataFrame:
    if name in SLICES:
        source, tenant = SLICES[name]
        return tenant_slice(t[source], tenant)
    if name == "controle_inadimplentes":
        return overdue_titles(t)
    if name == "dim_produtos_otimizada":
        return product_catalogue(t)
    raise KeyError(name)


ANALYTICS: tuple[str, ...] = ("dre_contabil", "dre_gerencial")
PLATINUM: tuple[str, ...] = ("controle_inadimplentes", *SLICES, "dim_produtos_otimizada")
