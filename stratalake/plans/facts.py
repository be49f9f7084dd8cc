"""Gold facts.

Every join is an equi-join on (tenant_id, key). No broadcast is forced: Spark
broadcasts a dimension when its measured size allows, otherwise it sorts and
merges, and AQE splits the partition of a hot key. Where a dimension only
proves existence its own columns are not read beyond the key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import calendar_days, date_key, full_days, surrogate_key
from stratalake.functions.temporal import as_of_date
from stratalake.operators.lookback import lookback, lookback_start, within_lookback
from stratalake.session import materialise
from stratalake.sources.months import MONTH, by_month, event_range

Tables = Mapping[str, DataFrame]
Now = dt.datetime | str | Column | None
AsOf = dt.date | str | Column | None
Attributes = Callable[[DataFrame], DataFrame] | None

AUDIT = "_dbt_loaded_at"


def arranged(rows: DataFrame, columns: Sequence[str], arrange: Attributes) -> DataFrame:
    """``columns`` of the rows, dealt out for the write, if it deals them out, before hashed keys make them wide."""
    rows = rows.select(*columns)
    return rows if arrange is None else arrange(rows)


def known(rows: DataFrame, parents: DataFrame, on: Sequence[str], unknown: DataFrame | None = None) -> DataFrame:
    """Rows whose ``on`` is a key of ``parents``, which is unique.

    Given the ``unknown`` keys of the rows, which were counted and are few, these are taken away instead: the rows
    stay where they are, however many the parents.
    """
    if unknown is None:
        return rows.join(parents.select(*on), list(on), "left_semi")
    complete = reduce(and_, [F.col(c).isNotNull() for c in on])
    return rows.filter(complete).join(F.broadcast(unknown), list(on), "left_anti")


def sales(
    t: Tables,
    incremental: bool = False,
    now: Now = None,
    of_sale: Attributes = None,
    of_line: Attributes = None,
    arrange: Attributes = None,
) -> DataFrame:
    """Order lines with their sale header. Foreign keys are hashed, the dimensions are not joined.

    ``of_sale`` and ``of_line`` add attributes to the headers and to the lines ahead of their join, where there are
    fewer rows or narrower ones; they follow the columns of the fact.
    """
    header = by_month(t, "silver_dw_vendas")
    if incremental:
        header = event_range(header, "dt_venda", lookback_start(now))
    header = header.select("tenant_id", "venda_id", "cliente_id", "vendedor_id", "ds_status", "dt_venda")
    lines = t["silver_dw_itens_pedido"]
    added = []
    if of_sale is not None:
        before, header = header.columns, of_sale(header)
        added += [c for c in header.columns if c not in before]
    if of_line is not None:
        before, lines = lines.columns, of_line(lines)
        added += [c for c in lines.columns if c not in before]
    columns = [
        "tenant_id", "item_id", "venda_id", "cliente_id", "vendedor_id", "produto_id", "ds_status",
        "qtd_vendida", "vlr_unitario", "vlr_total", "dt_venda", "created_at", *added,
    ]
    return arranged(lines.join(header, ["tenant_id", "venda_id"]), columns, arrange).select(
        surrogate_key("tenant_id", "item_id").alias("venda_item_sk"),
        "tenant_id",
        "item_id",
        "venda_id",
        surrogate_key("tenant_id", "cliente_id").alias("cliente_sk"),
        surrogate_key("tenant_id", "vendedor_id").alias("vendedor_sk"),
        surrogate_key("tenant_id", "produto_id").alias("produto_sk"),
        date_key("dt_venda").alias("data_id"),
        "cliente_id",
        "vendedor_id",
        "produto_id",
        "ds_status",
        "qtd_vendida",
        "vlr_unitario",
        "vlr_total",
        "dt_venda",
        "created_at",
        F.current_timestamp().alias(AUDIT),
        *added,
    )


def purchase_orders(
    t: Tables, incremental: bool = False, now: Now = None, unknown: DataFrame | None = None, arrange: Attributes = None
) -> DataFrame:
    """Orders of known suppliers. The supplier key is unique, so a semi join suffices."""
    orders = by_month(t, "silver_dw_ordens_compra")
    if incremental:
        orders = event_range(orders, "dt_emissao", lookback_start(now).cast("date"))
    orders = known(orders, t["silver_dw_fornecedores"], ["tenant_id", "fornecedor_id"], unknown)
    columns = [
        "tenant_id", "ordem_compra_id", "fornecedor_id", "ds_status", "vlr_total", "dt_emissao", "created_at",
    ]
    return arranged(orders, columns, arrange).select(
        surrogate_key("tenant_id", "ordem_compra_id").alias("ordem_compra_sk"),
        "tenant_id",
        "ordem_compra_id",
        surrogate_key("tenant_id", "fornecedor_id").alias("fornecedor_sk"),
        date_key("dt_emissao").alias("data_id"),
        "fornecedor_id",
        "ds_status",
        "vlr_total",
        "dt_emissao",
        "created_at",
        F.current_timestamp().alias(AUDIT),
    )


def production_orders(
    t: Tables,
    incremental: bool = False,
    now: Now = None,
    as_of: AsOf = None,
    pending: DataFrame | None = None,
    unknown: DataFrame | None = None,
    arrange: Attributes = None,
) -> DataFrame:
    """Days in production up to the end date, or up to ``as_of`` while running; orders of known products.

    The product key is unique, so a semi join suffices; its hash is made anew.

    The days of a running order move with the calendar, and the order may end long after its start. Given the
    ``pending`` keys (stored without an end), an incremental run evaluates those again as well.
    """
    orders = by_month(t, "silver_dw_ordens_producao")
    if incremental:
        low = lookback_start(now).cast("date")
        recent = event_range(orders, "dt_inicio", low)
        if pending is not None:
            older = orders.filter(~F.coalesce(F.col("dt_inicio") >= low, F.lit(False)))
            recent = recent.unionByName(older.join(pending, list(KEYS["fct_ordens_producao"]), "left_semi"))
        orders = recent
    orders = known(orders, t["dim_produtos"], ["tenant_id", "produto_id"], unknown)
    columns = [
        "tenant_id", "ordem_producao_id", "produto_id", "qt_produzida", "dt_inicio", "dt_fim", "ds_status", "created_at",
    ]
    return arranged(orders, columns, arrange).select(
        surrogate_key("tenant_id", "ordem_producao_id").alias("ordem_producao_sk"),
        "tenant_id",
        "ordem_producao_id",
        surrogate_key("tenant_id", "produto_id").alias("produto_sk"),
        date_key("dt_inicio").alias("data_id"),
        "qt_produzida",
        calendar_days("dt_inicio", F.coalesce("dt_fim", as_of_date(as_of))).alias("nr_dias_producao"),
        "dt_inicio",
        "dt_fim",
        "ds_status",
        "created_at",
    )


def shipments(
    t: Tables, incremental: bool = False, now: Now = None, unknown: DataFrame | None = None, arrange: Attributes = None
) -> DataFrame:
    """Delivery delay in days: negative early, positive late, NULL while undelivered.

    Only shipments of known carriers; the carrier key is unique, so a semi join suffices.
    """
    rows = t["silver_dw_expedicao"]
    if incremental:
        rows = lookback(rows, "updated_at", now)
    rows = known(rows, t["silver_dw_transportadoras"], ["tenant_id", "transportadora_id"], unknown)
    columns = [
        "tenant_id", "expedicao_id", "venda_id", "transportadora_id", "dt_expedicao", "dt_entrega_prevista",
        "dt_entrega_realizada", "ds_status", "updated_at", "created_at",
    ]
    return arranged(rows, columns, arrange).select(
        surrogate_key("tenant_id", "expedicao_id").alias("expedicao_sk"),
        "tenant_id",
        "expedicao_id",
        "venda_id",
        surrogate_key("tenant_id", "transportadora_id").alias("transportadora_sk"),
        date_key("dt_expedicao").alias("data_id"),
        "dt_expedicao",
        "dt_entrega_prevista",
        "dt_entrega_realizada",
        # datediff is NULL for a NULL delivery date
        calendar_days("dt_entrega_prevista", "dt_entrega_realizada").alias("nr_dias_atraso"),
        "ds_status",
        "updated_at",
        "created_at",
    )


def project_budgets(t: Tables, incremental: bool = False, now: Now = None) -> DataFrame:
    """Actual minus budget: positive is an overrun."""
    budgets = t["silver_dw_orcamento"]
    if incremental:
        budgets = lookback(budgets, "created_at", now)
    centres = t["dim_centros_custos"].select("tenant_id", "centro_custo_id", "centro_custo_sk")
    return budgets.join(centres, ["tenant_id", "centro_custo_id"]).select(
        surrogate_key("tenant_id", "orcamento_id").alias("orcamento_sk"),
        "tenant_id",
        "orcamento_id",
        "projeto_id",
        "centro_custo_sk",
        date_key("dt_competencia").alias("data_id"),
        "vlr_orcado",
        "vlr_realizado",
        (F.col("vlr_realizado") - F.col("vlr_orcado")).cast("decimal(18,2)").alias("vlr_delta"),
        "dt_competencia",
        "created_at",
    )


def titles(
    t: Tables,
    incremental: bool = False,
    now: Now = None,
    as_of: AsOf = None,
    pending: DataFrame | None = None,
) -> DataFrame:
    """Settlement state and lateness of every title as of a day.

    The due date keeps its time of day: a title due yesterday at 10:00 is
    overdue with 0 complete days. Any settlement counts as settled, whatever
    its value. A full build neither joins nor shuffles.

    State and lateness move with the calendar and with settlements, not only with new
    titles. Given the ``pending`` keys (titles stored as open or overdue, or with a
    settlement that has just come in), an incremental run evaluates those again as well.
    """
    rows = t["silver_dw_titulos_financeiros"]
    if incremental:
        recent = within_lookback("created_at", now)
        selected = rows.filter(recent)
        if pending is not None:
            older = rows.filter(~F.coalesce(recent, F.lit(False)))
            selected = selected.unionByName(
                older.join(pending, list(KEYS["fct_titulo_financeiro"]), "left_semi")
            )
        rows = selected
    today = as_of_date(as_of).cast("timestamp_ntz")
    settled = F.col("dt_baixa").isNotNull()
    late = F.col("dt_vencimento") < today
    state = F.when(settled, "LIQUIDADO").when(late, "VENCIDO").otherwise("EM_ABERTO")
    days_late = F.when(~settled & late, full_days("dt_vencimento", today)).otherwise(F.lit(0))
    return rows.select(
        surrogate_key("tenant_id", "titulo_id", "tipo_titulo").alias("titulo_sk"),
        "tenant_id",
        "titulo_id",
        "tipo_titulo",
        "entidade_id",
        "dt_emissao",
        "dt_vencimento",
        "vlr_titulo",
        "dt_baixa",
        "vlr_baixado",
        state.alias("ds_situacao_titulo"),
        days_late.cast("bigint").alias("nr_dias_atraso"),
        date_key("dt_vencimento").alias("data_id"),
        "created_at",
    )


def running_orders(stored: DataFrame) -> DataFrame:
    """Keys of stored orders without an end, whether or not they have ended since."""
    return stored.filter(F.col("dt_fim").isNull()).select(*KEYS["fct_ordens_producao"])


def open_titles(stored: DataFrame) -> DataFrame:
    """Keys of stored titles whose state can still change."""
    return stored.filter(F.col("ds_situacao_titulo").isin("EM_ABERTO", "VENCIDO")).select(
        *KEYS["fct_titulo_financeiro"]
    )


def ledger_entries(
    t: Tables, incremental: bool = False, now: Now = None, small_chart: bool = False
) -> DataFrame:
    """Entries with their account type; only a credit is positive.

    A chart of accounts that was counted and is small is broadcast; the entries then stay in their files.
    """
    entries = t["silver_dw_lancamentos"]
    if incremental:
        entries = lookback(entries, "created_at", now)
    accounts = t["dim_plano_contas"].select(
        "tenant_id", "plano_conta_id", "plano_conta_sk", "cd_tipo_conta"
    )
    if small_chart:
        accounts = F.broadcast(accounts)
    value = F.col("vlr_lancamento")
    signed = F.when(F.col("cd_tipo_lancamento") == "CREDITO", value).otherwise(-value)
    return entries.join(accounts, ["tenant_id", "plano_conta_id"]).select(
        surrogate_key("tenant_id", "lancamento_id").alias("lancamento_sk"),
        "tenant_id",
        "lancamento_id",
        "plano_conta_sk",
        "cd_tipo_conta",
        "cd_tipo_lancamento",
        date_key("dt_competencia").alias("data_id"),
        "vlr_lancamento",
        signed.cast("decimal(18,2)").alias("vlr_final"),
        "ds_historico",
        "dt_competencia",
        "created_at",
    )


BUILDERS = {
    "fct_vendas": sales,
    "fct_ordens_compra": purchase_orders,
    "fct_ordens_producao": production_orders,
    "fct_expedicao": shipments,
    "fct_orcamento_projetos": project_budgets,
    "fct_titulo_financeiro": titles,
    "fct_lancamentos": ledger_entries,
}

KEYS = {
    "fct_vendas": ("tenant_id", "item_id"),
    "fct_ordens_compra": ("tenant_id", "ordem_compra_id"),
    "fct_ordens_producao": ("tenant_id", "ordem_producao_id"),
    "fct_expedicao": ("tenant_id", "expedicao_id"),
    "fct_orcamento_projetos": ("tenant_id", "orcamento_id"),
    "fct_titulo_financeiro": ("tenant_id", "titulo_id", "tipo_titulo"),
    "fct_lancamentos": ("tenant_id", "lancamento_id"),
}

# The hash of a fact's own key, which follows from it.
OWN_KEY = {
    "fct_vendas": "venda_item_sk",
    "fct_ordens_compra": "ordem_compra_sk",
    "fct_ordens_producao": "ordem_producao_sk",
    "fct_expedicao": "expedicao_sk",
    "fct_orcamento_projetos": "orcamento_sk",
    "fct_titulo_financeiro": "titulo_sk",
    "fct_lancamentos": "lancamento_sk",
}


def derived(name: str) -> dict[str, Column]:
    """Columns of a stored fact that can be made again from others of the row."""
    return {OWN_KEY[name]: surrogate_key(*KEYS[name])} if name in OWN_KEY else {}


_AS_OF = {"fct_ordens_producao", "fct_titulo_financeiro"}

SMALL_CHART = 10_000  # accounts

# Facts whose rows only need a known parent: (rows, parents, key of the parent).
PROVED = {
    "fct_ordens_compra": ("silver_dw_ordens_compra", "silver_dw_fornecedores", "fornecedor_id"),
    "fct_ordens_producao": ("silver_dw_ordens_producao", "dim_produtos", "produto_id"),
    "fct_expedicao": ("silver_dw_expedicao", "silver_dw_transportadoras", "transportadora_id"),
}
FEW_UNKNOWN = 10_000  # keys

# Facts that are dealt out for their write before their keys are hashed.
KEYED_LATE = frozenset({"fct_vendas", *PROVED})


def few_unknown(name: str, t: Tables) -> DataFrame | None:
    """The keys that stored rows of a fact refer to and that no stored parent has, if they are few.

    Only distinct keys are shuffled for it, not the rows.
    """
    if name not in PROVED or any(n not in t for n in PROVED[name][:2]):
        return None
    rows, parents, key = PROVED[name]
    on = ["tenant_id", key]
    referred = t[rows].select(*on).filter(F.col("tenant_id").isNotNull() & F.col(key).isNotNull()).distinct()
    missing = materialise(referred.join(t[parents].select(*on), on, "left_anti"), "unknown")
    return missing if missing.count() <= FEW_UNKNOWN else None


def stays_in_months(name: str, t: Tables, unknown: DataFrame | None = None) -> bool:
    """Whether a full build takes each row of the fact from a stored row of the same month, without a shuffle.

    ``unknown``: what ``few_unknown`` has found.
    """
    source = {
        "fct_titulo_financeiro": "silver_dw_titulos_financeiros",
        "fct_lancamentos": "silver_dw_lancamentos",
        **{fact: rows for fact, (rows, _, _) in PROVED.items()},
    }
    if name not in source or source[name] not in t or MONTH not in by_month(t, source[name]).columns:
        return False
    if name in PROVED:
        return unknown is not None
    if name == "fct_titulo_financeiro":
        return True
    return "dim_plano_contas" in t and t["dim_plano_contas"].count() <= SMALL_CHART


def build(
    name: str,
    t: Tables,
    incremental: bool = False,
    now: Now = None,
    as_of: AsOf = None,
    stored: DataFrame | None = None,
    settled: DataFrame | None = None,
    small_chart: bool = False,
    unknown: DataFrame | None = None,
    arrange: Attributes = None,
) -> DataFrame:
    """``stored``: the current content of the fact; ``settled``: keys of titles with new settlements.

    ``unknown`` and ``arrange`` are for full builds that write: see ``few_unknown`` and ``KEYED_LATE``.
    """
    extra = {}
    if name in PROVED:
        extra["unknown"] = unknown
    if name in KEYED_LATE:
        extra["arrange"] = arrange
    if name == "fct_lancamentos":
        extra["small_chart"] = small_chart
    if name in ("fct_ordens_producao", "fct_titulo_financeiro"):
        extra["as_of"] = as_of
    if name == "fct_titulo_financeiro" and incremental and stored is not None:
        pending = open_titles(stored)
        extra["pending"] = pending if settled is None else pending.union(settled.select(*pending.columns)).distinct()
    if name == "fct_ordens_producao" and incremental and stored is not None:
        extra["pending"] = running_orders(stored)
    return BUILDERS[name](t, incremental=incremental, now=now, **extra)


MODELS: tuple[str, ...] = tuple(BUILDERS)
