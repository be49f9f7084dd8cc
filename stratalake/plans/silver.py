"""Silver layer: typed, cleaned, one row per key.

Eighteen of the twenty-one tables differ only in columns and keys, so they are
declared as :class:`SilverSpec` and built by one function. The other three have
no dedup; one of them (finance titles) is a union with settlements.

A feed is any DataFrame with the conformed input columns. Nothing here triggers
a job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import digits_only, norm_default, norm_lower, norm_upper
from stratalake.operators.dedup import dedup_latest
from stratalake.operators.lookback import lookback, within_lookback
from stratalake.sources.bronze import delivered_since, has_delivery_day

Feeds = Mapping[str, DataFrame]
Now = dt.datetime | str | Column | None

AUDIT = "_dbt_loaded_at"


def as_is(c: str) -> Column:
    return F.col(c)


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def quantity(c: str) -> Column:
    return F.col(c).cast("decimal(18,4)")


def day(c: str) -> Column:
    return F.col(c).cast("date")


def instant(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz")


def or_na(c: str) -> Column:
    return norm_default(c, "NA")


def or_blank(c: str) -> Column:
    return norm_default(c, "")


Rule = Callable[[str], Column]


@dataclass(frozen=True)
class SilverSpec:
    """``columns`` maps output name to (input name, rule); key and tenant are implied."""

    feed: str
    key: str
    columns: Mapping[str, tuple[str, Rule]]
    watermark: str = "created_at"
    lookback_on: str | None = None
    dedup: bool = True

    @property
    def keys(self) -> tuple[str, str]:
        return ("tenant_id", self.key)


def _same(name: str, rule: Rule = as_is) -> dict[str, tuple[str, Rule]]:
    return {name: (name, rule)}


_CREATED = _same("created_at", instant)
_CREATED_UPDATED = {**_CREATED, **_same("updated_at", instant)}

SPECS: dict[str, SilverSpec] = {
    # sales
    "silver_dw_clientes": SilverSpec(
        "clientes",
        "cliente_id",
        {
            "nm_cliente": ("nome", norm_upper),
            "nr_documento": ("documento", digits_only),
            "ds_email": ("email", norm_lower),
            "nm_cidade": ("cidade", norm_upper),
            "cd_uf": ("uf", norm_upper),
            **_CREATED_UPDATED,
        },
        watermark="updated_at",
    ),
    "silver_dw_vendedores": SilverSpec(
        "vendedores",
        "vendedor_id",
        {"nm_vendedor": ("nome", norm_upper), **_same("filial_id"), **_CREATED_UPDATED},
        watermark="updated_at",
    ),
    "silver_dw_produtos": SilverSpec(
        "produtos",
        "produto_id",
        {
            "dsc_produto": ("descricao", norm_upper),
            "nm_categoria": ("categoria", or_na),
            "vlr_preco_unitario": ("preco_unitario", money),
            **_CREATED_UPDATED,
        },
        watermark="updated_at",
    ),
    # The lookback is on the sale date: a status change of an older sale needs a full build.
    "silver_dw_vendas": SilverSpec(
        "vendas",
        "venda_id",
        {
            **_same("dt_venda", instant),
            **_same("cliente_id"),
            **_same("vendedor_id"),
            **_same("vlr_total", money),
            "ds_status": ("status", norm_upper),
            **_CREATED_UPDATED,
        },
        watermark="updated_at",
        lookback_on="dt_venda",
    ),
    "silver_dw_itens_pedido": SilverSpec(
        "itens_pedido",
        "item_id",
        {
            **_same("venda_id"),
            **_same("produto_id"),
            **_same("qtd_vendida", quantity),
            **_same("vlr_unitario", money),
            **_same("vlr_total", money),
            **_CREATED,
        },
    ),
    # purchasing
    "silver_dw_fornecedores": SilverSpec(
        "fornecedores",
        "fornecedor_id",
        {"nm_fornecedor": ("nome", norm_upper), "nr_documento": ("documento", digits_only), **_CREATED},
    ),
    "silver_dw_ordens_compra": SilverSpec(
        "ordens_compra",
        "ordem_compra_id",
        {
            **_same("fornecedor_id"),
            **_same("dt_emissao", day),
            **_same("vlr_total", money),
            "ds_status": ("status", norm_upper),
            **_CREATED_UPDATED,
        },
        watermark="updated_at",
    ),
    # corporate
    "silver_dw_empresas": SilverSpec(
        "empresas",
        "empresa_id",
        {"nm_empresa": ("razao_social", norm_upper), "nr_documento": ("documento", digits_only), **_CREATED},
    ),
    "silver_dw_departamentos": SilverSpec(
        "departamentos", "departamento_id", {"nm_departamento": ("nome", norm_upper), **_CREATED}
    ),
    "silver_dw_funcionarios": SilverSpec(
        "funcionarios",
        "funcionario_id",
        {
            "nm_funcionario": ("nome", norm_upper),
            **_same("departamento_id"),
            "ds_cargo": ("cargo", norm_upper),
            **_same("dt_admissao", day),
            **_CREATED,
        },
    ),
    # manufacturing
    "silver_dw_materias_primas": SilverSpec(
        "materias_primas",
        "materia_prima_id",
        {
            "nm_materia_prima": ("nome", norm_upper),
            "ds_unidade_medida": ("unidade_medida", norm_upper),
            "vlr_preco_unitario": ("preco_unitario", quantity),
            **_CREATED,
        },
    ),
    "silver_dw_ordens_producao": SilverSpec(
        "ordens_producao",
        "ordem_producao_id",
        {
            **_same("produto_id"),
            **_same("qt_produzida", quantity),
            **_same("dt_inicio", day),
            **_same("dt_fim", day),
            **_same("ds_status", norm_upper),
            **_CREATED,
        },
    ),
    # logistics
    "silver_dw_filiais": SilverSpec(
        "filiais",
        "filial_id",
        {
            "nm_filial": ("nome", norm_upper),
            "nm_cidade": ("cidade", norm_upper),
            "sg_uf": ("uf", norm_upper),
            **_CREATED,
        },
    ),
    "silver_dw_transportadoras": SilverSpec(
        "transportadoras",
        "transportadora_id",
        {
            "nm_transportadora": ("nome", norm_upper),
            "nr_documento": ("documento", digits_only),
            **_CREATED,
        },
    ),
    "silver_dw_expedicao": SilverSpec(
        "expedicao",
        "expedicao_id",
        {
            **_same("venda_id"),
            **_same("transportadora_id"),
            **_same("dt_expedicao", day),
            **_same("dt_entrega_prevista", day),
            **_same("dt_entrega_realizada", day),
            **_same("ds_status", norm_upper),
            **_same("updated_at", instant),
            **_CREATED,
        },
        watermark="updated_at",
    ),
    # controlling
    "silver_dw_centros_custos": SilverSpec(
        "centros_custos", "centro_custo_id", {"nm_centro_custo": ("nome", norm_upper), **_CREATED}
    ),
    "silver_dw_projetos": SilverSpec(
        "projetos",
        "projeto_id",
        {
            "nm_projeto": ("nome", norm_upper),
            **_same("centro_custo_id"),
            **_same("dt_inicio", day),
            **_same("dt_fim", day),
            **_CREATED,
        },
    ),
    "silver_dw_orcamento": SilverSpec(
        "orcamento",
        "orcamento_id",
        {
            **_same("projeto_id"),
            **_same("centro_custo_id"),
            "dt_competencia": ("competencia", day),
            **_same("vlr_orcado", money),
            **_same("vlr_realizado", money),
            **_CREATED,
        },
    ),
    # accounting: neither key filter nor audit column; repeated keys keep the latest row, as in a merge
    "silver_dw_plano_contas": SilverSpec(
        "plano_contas",
        "plano_conta_id",
        {
            "cd_conta": ("codigo", norm_upper),
            "ds_conta": ("descricao", norm_upper),
            "cd_tipo_conta": ("tipo", norm_upper),
            **_same("created_at"),
        },
        dedup=False,
    ),
    "silver_dw_lancamentos": SilverSpec(
        "lancamentos",
        "lancamento_id",
        {
            "cd_tipo_lancamento": ("cd_tipo_lancamento", norm_upper),
            **_same("plano_conta_id"),
            **_same("dt_competencia", day),
            **_same("vlr_lancamento", money),
            "ds_historico": ("historico", or_blank),
            **_same("created_at"),
        },
        dedup=False,
    ),
}

TITLES = "silver_dw_titulos_financeiros"
TITLE_KEYS = ("tenant_id", "titulo_id", "tipo_titulo")


def clean(
    spec: SilverSpec,
    feed: DataFrame,
    incremental: bool = False,
    now: Now = None,
    delivered_from: dt.date | None = None,
) -> DataFrame:
    """Filter, normalise and dedup one feed. Filters precede the projection and reach the scan.

    ``delivered_from`` lets an incremental run open only the directories of that
    delivery day and later. It is exact where rows are delivered on or after the
    day of their watermark.
    """
    if spec.dedup:
        feed = feed.filter(F.col(spec.key).isNotNull())
    if incremental and delivered_from is not None and has_delivery_day(feed):
        feed = delivered_since(feed, delivered_from)
    if incremental:
        feed = lookback(feed, spec.lookback_on or spec.watermark, now)
    rows = feed.select(
        *spec.keys, *[rule(source).alias(out) for out, (source, rule) in spec.columns.items()]
    )
    rows = dedup_latest(rows, spec.keys, spec.watermark)
    return rows.withColumn(AUDIT, F.current_timestamp()) if spec.dedup else rows


def settlements_per_title(settlements: DataFrame) -> DataFrame:
    """Latest date and total per title; partial aggregation combines before the shuffle."""
    return settlements.groupBy(*TITLE_KEYS).agg(
        F.max("dt_baixa").alias("dt_baixa"), F.sum("vlr_baixado").alias("vlr_baixado")
    )


def recently_settled(feeds: Feeds, now: Now = None, delivered_from: dt.date | None = None) -> DataFrame:
    """Keys of the titles with a settlement that has just come in.

    By the day of its delivery where the feed has one, else by its creation: the date
    of the settlement itself may lie any time back. It only serves feeds that have neither.
    """
    rows = feeds["baixas"]
    if delivered_from is not None and has_delivery_day(rows):
        rows = delivered_since(rows, delivered_from)
    else:
        rows = lookback(rows, "created_at" if "created_at" in rows.columns else "dt_baixa", now)
    return rows.select(*TITLE_KEYS).distinct()


def finance_titles(
    feeds: Feeds,
    incremental: bool = False,
    now: Now = None,
    follow_settlements: bool = True,
    delivered_from: dt.date | None = None,
) -> DataFrame:
    """Payables and receivables in one table with their settlements; the latest row of a title counts.

    Settlements keep arriving long after a title was created. With
    ``follow_settlements`` an incremental run also selects the titles with a settlement
    that has just come in; without it only recently created titles are selected. Only
    settlements of selected titles are summed.
    """

    def side(feed: str, kind: str, party: str) -> DataFrame:
        return feeds[feed].select(
            "tenant_id",
            "titulo_id",
            F.lit(kind).alias("tipo_titulo"),
            F.col(party).alias("entidade_id"),
            "dt_emissao",
            "dt_vencimento",
            "vlr_titulo",
            "created_at",
        )

    titles = side("titulos_pagar", "PAGAR", "fornecedor_id").unionByName(
        side("titulos_receber", "RECEBER", "cliente_id")
    )
    settlements = feeds["baixas"]
    if incremental:
        if follow_settlements:
            fresh = recently_settled(feeds, now, delivered_from).withColumn("_settled", F.lit(True))
            marked = titles.join(fresh, list(TITLE_KEYS), "left")
            titles = marked.filter(F.col("_settled") | within_lookback("created_at", now)).drop("_settled")
        else:
            titles = lookback(titles, "created_at", now)
        settlements = settlements.join(titles.select(*TITLE_KEYS), list(TITLE_KEYS), "left_semi")
    titles = dedup_latest(titles, TITLE_KEYS, "created_at")
    return titles.join(settlements_per_title(settlements), list(TITLE_KEYS), "left").select(
        *TITLE_KEYS,
        "entidade_id",
        "dt_emissao",
        "dt_vencimento",
        F.col("vlr_titulo").cast("decimal(18,2)").alias("vlr_titulo"),
        "dt_baixa",
        F.coalesce(F.col("vlr_baixado"), F.lit(0)).cast("decimal(18,2)").alias("vlr_baixado"),
        "created_at",
    )


def build(
    name: str,
    feeds: Feeds,
    incremental: bool = False,
    now: Now = None,
    delivered_from: dt.date | None = None,
) -> DataFrame:
    """Titles look up older rows by their settlements, so they always see all their deliveries."""
    if name == TITLES:
        return finance_titles(feeds, incremental, now, delivered_from=delivered_from)
    spec = SPECS[name]
    return clean(spec, feeds[spec.feed], incremental, now, delivered_from)


def keys_of(name: str) -> tuple[str, ...]:
    return TITLE_KEYS if name == TITLES else SPECS[name].keys


def watermark_of(name: str) -> str:
    return "created_at" if name == TITLES else SPECS[name].watermark


MODELS: tuple[str, ...] = (*SPECS, TITLES)
