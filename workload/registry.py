"""Registered queries, one per inventory id, with their SQL checks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import functions as fn
from stratalake.functions.temporal import as_of_date
from stratalake.operators import quality
from stratalake.operators.dedup import dedup_latest
from stratalake.operators.lookback import lookback, since_high_water, within_lookback
from stratalake.operators.quality import summarise
from stratalake.operators.upsert import upsert
from stratalake.plans import analytics, checks, dims, silver
from stratalake.plans.build import build_layers, check_results
from stratalake.plans.catalogue import LAYER_OF, Models
from stratalake.session import materialise, scratch_path
from stratalake.sources import bronze, conform
from stratalake.sources.contract import TENANTS, data_schema
from stratalake.sources.tables import Lake, compact
from stratalake.streaming.ingest import stream_feed, upsert_stream
from workload import feeds as feed_columns
from workload import oracle
from workload.feeds import Feeds, Revised

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2000-01-01"
NOW = "2000-01-01 00:00:00"
# Two days after all dates of the data, for runs on one day after the other.
DAY_ONE, DAY_TWO = "2003-06-01 00:00:00", "2003-06-02 00:00:00"
CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(spark, Feeds(spark, sf_dir), as_of=AS_OF, calendar=CALENDAR)


def register(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if check is not None:
            ORACLE[name] = oracle.sql(check)
        return query

    return add


def _model_query(model: str) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir)[model].drop("_dbt_loaded_at")


# Inventory numbers of the models.
IDS = {
    "sv": [
        "clientes", "vendedores", "produtos", "vendas", "itens_pedido", "fornecedores",
        "ordens_compra", "empresas", "departamentos", "funcionarios", "materias_primas",
        "ordens_producao", "filiais", "transportadoras", "expedicao", "centros_custos", "projetos",
        "orcamento", "titulos_financeiros", "plano_contas", "lancamentos",
    ],
    "gd": [
        "dim_calendrio", "dim_clientes", "dim_produtos", "dim_vendedores", "dim_fornecedores",
        "dim_empresas", "dim_funcionarios", "dim_centros_custos", "dim_plano_contas",
    ],
    "gf": [
        "fct_vendas", "fct_ordens_compra", "fct_ordens_producao", "fct_expedicao",
        "fct_orcamento_projetos", "fct_titulo_financeiro", "fct_lancamentos",
    ],
    "ga": ["dre_contabil", "dre_gerencial"],
    "pl": [
        "controle_inadimplentes", "dre_contabil_unit_01", "dre_contabil_unit_02",
        "dre_gerencial_unit_01", "dre_gerencial_unit_02", "dim_produtos_otimizada",
    ],
}

for _group, _names in IDS.items():
    for _number, _name in enumerate(_names, start=1):
        _model = f"silver_dw_{_name}" if _group == "sv" else _name
        assert _model in LAYER_OF
        _label = f"silver_{_name}" if _group == "sv" else _name
        if _model != "dim_calendrio":
            register(f"{_group}{_number:02d}_{_label}", _model)(_model_query(_model))

register(
    "gd01_dim_calendrio",
    oracle.CTES["dim_calendrio"].replace(
        "generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day) g(d)",
        """(select unnest(generate_series(make_date(min(year(l_shipdate)), 1, 1)::timestamp,
           make_date(max(year(l_shipdate)), 12, 31)::timestamp, interval 1 day)) d from lineitem)""",
    ),
)(lambda spark, sf_dir: dims.calendar_covering(Feeds(spark, sf_dir).source["lineitem"], "l_shipdate"))


# Marts described beyond the stored models ------------------------------------------------------

register(
    "pl07_overdue_by_customer",
    """select tenant_id, entidade_id cliente_id, cliente_sk, nm_cliente, nr_documento,
    cast(sum(vlr_titulo) as decimal(18,2)) vlr_inadimplente,
    cast(sum(nr_dias_atraso) // count(*) as bigint) dias_atraso_medio, count(*) qtd_titulos_vencidos
    from fct_titulo_financeiro f
    left join (select tenant_id, cliente_id entidade_id, cliente_sk, nm_cliente, nr_documento
               from dim_clientes) c using (tenant_id, entidade_id)
    where ds_situacao_titulo = 'VENCIDO' and tipo_titulo = 'RECEBER' and nr_dias_atraso > 30
    group by all""",
)(lambda spark, sf_dir: analytics.overdue_by_customer(models(spark, sf_dir)))

register(
    "pl08_group_statement",
    """select cd_tipo_conta, dt_competencia, cast(sum(vlr_final) as decimal(18,2)) vlr_total
    from fct_lancamentos group by all""",
)(lambda spark, sf_dir: analytics.group_statement(models(spark, sf_dir)))

register(
    "pl09_enriched_sales",
    """select v.tenant_id, item_id, venda_id, v.cliente_sk, v.produto_sk, v.vendedor_sk, v.data_id,
    ds_status, qtd_vendida, vlr_total, nm_ano_mes, nr_trimestre, fl_fim_de_semana, nm_vendedor,
    vd.filial_id, dsc_produto, nm_categoria, nm_cliente, cd_uf, empresa_sk, nm_empresa
    from fct_vendas v left join dim_calendrio d on v.data_id = d.data_id
    left join dim_vendedores vd on v.tenant_id = vd.tenant_id and v.vendedor_sk = vd.vendedor_sk
    left join dim_produtos p on v.tenant_id = p.tenant_id and v.produto_sk = p.produto_sk
    left join dim_clientes c on v.tenant_id = c.tenant_id and v.cliente_sk = c.cliente_sk
    left join dim_empresas e on v.tenant_id = e.tenant_id and vd.filial_id = e.empresa_id""",
)(lambda spark, sf_dir: analytics.enriched_sales(models(spark, sf_dir)))


# Sources and sinks -----------------------------------------------------------------------------

DELIVERED = """select *, cast(year(created_at) as int) as year, cast(1 as int) as month,
    cast(1 as int) as day from vendas"""


def deliver(spark: SparkSession, sf_dir: str) -> str:
    """The sales feed as yearly Bronze deliveries; returns the root."""
    root = scratch_path(spark, "bronze")
    feed = Feeds(spark, sf_dir)["vendas"]
    bronze.write_bronze(with_delivery_year(feed), root, "comercial", "vendas")
    return root


def with_delivery_year(feed: DataFrame) -> DataFrame:
    return bronze.with_partition_day(feed, F.date_trunc("year", F.col("created_at")))


@register("sr01_read_bronze", DELIVERED)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas")


@register(
    "sr02_register_bronze",
    f"""select tenant_id, year, count(*) n_records, sum(vlr_total) vlr_total
    from ({DELIVERED}) group by all""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze.register_bronze(spark, deliver(spark, sf_dir))
    return spark.sql(
        """select tenant_id, year, count(*) as n_records,
        cast(sum(vlr_total) as decimal(38,2)) as vlr_total
        from bronze_dev_vendas group by tenant_id, year"""
    )


@register(
    "sr03_partition_pruning",
    f"""select * from ({DELIVERED})
    where tenant_id in ('unit_01', 'unit_02') and year between 1997 and 1999""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas")
    return bronze.prune(feed, ["unit_01", "unit_02"], dt.date(1997, 1, 1), dt.date(1999, 12, 31))


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"), prefix=f"q{uuid.uuid4().hex[:8]}_")


@register("sr04_layer_tables", "silver_dw_vendas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    lake.write(models(spark, sf_dir)["silver_dw_vendas"], "silver", "silver_dw_vendas")
    return lake.table("silver", "silver_dw_vendas").drop("_dbt_loaded_at")


@register(
    "sr05_conform_feed",
    """select tenant_id, lancamento_id, plano_conta_id,
    case when l.tax > 0.04 then 'CREDITO' else 'DEBITO' end cd_tipo_lancamento, dt_competencia,
    vlr_lancamento, historico, created_at
    from lancamentos join (
        select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         cast(l_extendedprice as decimal(18,2))) lancamento_id, any_value(l_tax) tax
        from lineitem group by all) l using (lancamento_id)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_feed("lancamentos", raw_ledger(Feeds(spark, sf_dir)))


def raw_ledger(feeds: Feeds) -> DataFrame:
    """The ledger as delivered: other names, debit and credit in two columns."""
    is_credit = F.col("l_tax") > 0.04
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    return feeds.source["lineitem"].select(
        feed_columns.tenant("l_orderkey").alias("tenant_id"),
        feed_columns.entry_id().alias("lancamento_id"),
        feed_columns.account_id().alias("conta_id"),
        feed_columns.month_start("l_shipdate").alias("dt_lancamento"),
        F.when(~is_credit, value).alias("vlr_debito"),
        F.when(is_credit, value).alias("vlr_credito"),
        F.when(
            F.col("l_returnflag") != "N",
            F.concat(F.lit("pedido "), F.col("l_orderkey").cast("string")),
        ).alias("historico"),
        F.col("l_shipdate").alias("created_at"),
    )


@register(
    "sr06_unify_tenants",
    """select tenant_id, fornecedor_id, nome, case when tenant_id <> 'unit_05' then documento end documento,
    case when tenant_id = 'unit_05' then documento end cnpj, created_at from fornecedores""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feeds(spark, sf_dir)["fornecedores"]
    extracts = {t: feed.filter(F.col("tenant_id") == t).drop("tenant_id") for t in TENANTS}
    extracts["unit_05"] = extracts["unit_05"].withColumnRenamed("documento", "cnpj")
    return bronze.unify_tenants(extracts)


@register(
    "sr07_write_bronze",
    f"""select * replace (case when year = 1998 then upper(status) else status end as status)
    from ({DELIVERED})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year is delivered again: its partitions are replaced, the others stay."""
    root = deliver(spark, sf_dir)
    again = with_delivery_year(Feeds(spark, sf_dir)["vendas"]).filter(F.col("year") == 1998)
    again = again.withColumn("status", F.upper("status"))
    for _attempt in range(2):
        bronze.write_bronze(again, root, "comercial", "vendas")
    return bronze.read_bronze(spark, root, "comercial", "vendas")


@register("sr08_full_rebuild", "dim_produtos")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, dim = new_lake(spark), models(spark, sf_dir)["dim_produtos"]
    lake.write(dim.withColumn("dsc_produto", F.lit("old")), "gold", "dim_produtos")
    lake.write(dim, "gold", "dim_produtos")
    return lake.table("gold", "dim_produtos").drop("_dbt_loaded_at")


register("sr09_view", "dre_contabil_unit_01")(
    lambda spark, sf_dir: new_lake(spark).view(
        models(spark, sf_dir)["dre_contabil_unit_01"], "platinum", "dre_contabil_unit_01"
    )
)


@register("sr10_incremental_merge", "silver_dw_titulos_financeiros")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receivables first with a stale value, then the corrected full batch."""
    rows = models(spark, sf_dir)["silver_dw_titulos_financeiros"]
    stale = rows.filter(F.col("tipo_titulo") == "RECEBER").withColumn(
        "vlr_titulo", F.lit(0).cast("decimal(18,2)")
    )
    table = new_lake(spark).name("silver", "titulos")
    upsert(stale, table, silver.TITLE_KEYS)
    return upsert(rows, table, silver.TITLE_KEYS, stable_partitions=True)


@register(
    "sr11_append_new_columns",
    """select tenant_id, fornecedor_id, nome, documento, created_at,
    case when tenant_id in ('unit_01', 'unit_02') then upper(documento) end codigo from fornecedores""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feeds(spark, sf_dir)["fornecedores"]
    table = new_lake(spark).name("silver", "fornecedores")
    upsert(feed, table, ("tenant_id", "fornecedor_id"))
    wider = feed.filter(F.col("tenant_id").isin("unit_01", "unit_02")).withColumn(
        "codigo", F.upper("documento")
    )
    return upsert(wider, table, ("tenant_id", "fornecedor_id"))


@register("sr12_compact", "silver_dw_vendas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    lake.write(
        models(spark, sf_dir)["silver_dw_vendas"].repartition(8, "venda_id"), "silver", "vendas"
    )
    compact(spark, lake.name("silver", "vendas"), "tenant_id in ('unit_01', 'unit_03')", 1)
    return lake.table("silver", "vendas").drop("_dbt_loaded_at")


# Shared cleaning operators ---------------------------------------------------------------------


def on_table(table: str, columns: Callable[[], tuple]) -> Query:
    """A projection of one driver table."""
    return lambda spark, sf_dir: Feeds(spark, sf_dir).source[table].select(*columns())


def on_feed(feed: str, columns: Callable[[], tuple]) -> Query:
    """A projection of one business feed."""
    return lambda spark, sf_dir: Feeds(spark, sf_dir)[feed].select(*columns())


register(
    "so01_keep_latest",
    """select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
    order by l_shipdate desc nulls last, l_partkey desc nulls last, l_suppkey desc nulls last,
    l_quantity desc nulls last, l_extendedprice desc nulls last) = 1""",
)(
    lambda spark, sf_dir: dedup_latest(
        Feeds(spark, sf_dir).source["lineitem"], ("l_orderkey", "l_linenumber"), "l_shipdate"
    )
)
register(
    "so02_drop_null_keys",
    "select tenant_id, ordem_compra_id, fornecedor_id from ordens_compra where fornecedor_id is not null",
)(
    lambda spark, sf_dir: Feeds(spark, sf_dir)["ordens_compra"]
    .filter(F.col("fornecedor_id").isNotNull())
    .select("tenant_id", "ordem_compra_id", "fornecedor_id")
)
register(
    "so03_norm_upper",
    "select tenant_id, cliente_id, upper(trim(nome, ' ' || chr(9))) nm_cliente from clientes",
)(on_feed("clientes", lambda: ("tenant_id", "cliente_id", fn.norm_upper("nome").alias("nm_cliente"))))
register(
    "so04_norm_lower", "select tenant_id, cliente_id, lower(trim(email)) ds_email from clientes"
)(on_feed("clientes", lambda: ("tenant_id", "cliente_id", fn.norm_lower("email").alias("ds_email"))))
register(
    "so05_digits_only",
    "select doc_id, regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') digits from documents",
)(
    lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", fn.digits_only("text").alias("digits")
    )
)
register(
    "so06_norm_default",
    "select tenant_id, produto_id, upper(trim(coalesce(categoria, 'NA'))) nm_categoria from produtos",
)(on_feed("produtos", lambda: ("tenant_id", "produto_id", fn.norm_default("categoria", "NA").alias("nm_categoria"))))
register(
    "so07_cast_contract",
    """select l_orderkey, l_linenumber, cast(l_quantity as decimal(18,4)) qtd,
    cast(l_extendedprice as decimal(18,2)) vlr, cast(l_shipdate as date) dt, l_shipdate ts from lineitem""",
)(
    on_table(
        "lineitem", lambda: ("l_orderkey", "l_linenumber",
        silver.quantity("l_quantity").alias("qtd"), silver.money("l_extendedprice").alias("vlr"),
        silver.day("l_shipdate").alias("dt"), silver.instant("l_shipdate").alias("ts")))
)
register(
    "so08_lookback",
    f"select * from vendas where dt_venda >= {oracle.NOW} - interval 2 days",
)(lambda spark, sf_dir: lookback(Feeds(spark, sf_dir)["vendas"], "dt_venda", NOW))
register("so09_load_audit", "select venda_id, true as is_stamped from silver_dw_vendas")(
    lambda spark, sf_dir: models(spark, sf_dir)["silver_dw_vendas"].select(
        "venda_id", F.col("_dbt_loaded_at").isNotNull().alias("is_stamped")
    )
)
register(
    "so10_surrogate_key",
    f"select tenant_id, ordem_compra_id, {oracle._sk('tenant_id', 'ordem_compra_id', 'fornecedor_id', 'dt_emissao::date')} sk"
    " from ordens_compra",
)(
    on_feed(
        "ordens_compra", lambda: ("tenant_id", "ordem_compra_id",
        fn.surrogate_key(
            "tenant_id", "ordem_compra_id", "fornecedor_id", F.col("dt_emissao").cast("date")
        ).alias("sk")))
)
register(
    "so11_date_key",
    "select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as int) data_id from orders",
)(on_table("orders", lambda: ("o_orderkey", fn.date_key("o_orderdate").alias("data_id"))))


# Scalar functions ------------------------------------------------------------------------------

register(
    "fn01_upper_lower_trim",
    """select c_custkey, upper(c_mktsegment) up, lower(c_name) low,
    trim('  ' || c_name || chr(9), ' ' || chr(9)) t from customer""",
)(
    on_table(
        "customer", lambda: ("c_custkey", F.upper("c_mktsegment").alias("up"), F.lower("c_name").alias("low"),
        fn.strip(F.concat(F.lit("  "), F.col("c_name"), F.lit("\t"))).alias("t")))
)
register(
    "fn02_regexp_delete",
    "select page_id, regexp_replace(url, '[^a-z]', '', 'g') letters from pages",
)(
    lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", F.regexp_replace("url", "[^a-z]", "").alias("letters")
    )
)
register(
    "fn03_coalesce",
    "select expedicao_id, coalesce(dt_entrega_realizada, dt_entrega_prevista) dt_entrega from expedicao",
)(
    on_feed(
        "expedicao", lambda: ("expedicao_id",
        F.coalesce("dt_entrega_realizada", "dt_entrega_prevista").alias("dt_entrega")))
)
register(
    "fn04_casts",
    """select l_orderkey, l_linenumber, cast(cast(l_extendedprice as decimal(18,4)) * 0.125 as decimal(18,2)) m,
    cast(l_shipdate as date) d, cast(l_quantity as int) q, cast(l_orderkey as varchar) s from lineitem""",
)(
    on_table(
        "lineitem", lambda: ("l_orderkey", "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(18,4)") * F.lit("0.125").cast("decimal(4,3)"))
        .cast("decimal(18,2)").alias("m"),
        F.col("l_shipdate").cast("date").alias("d"), F.col("l_quantity").cast("int").alias("q"),
        F.col("l_orderkey").cast("string").alias("s")))
)
register(
    "fn05_date_format",
    """select o_orderkey, strftime(o_orderdate, '%Y%m%d') ymd, strftime(o_orderdate, '%Y-%m') ym
    from orders""",
)(
    on_table(
        "orders", lambda: ("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"),
        fn.month_label("o_orderdate").alias("ym")))
)
register(
    "fn06_date_parts",
    """select o_orderkey, cast(year(o_orderdate) as int) y, cast(month(o_orderdate) as int) m,
    cast(day(o_orderdate) as int) d, cast(quarter(o_orderdate) as int) q from orders""",
)(
    on_table(
        "orders", lambda: ("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"), F.quarter("o_orderdate").alias("q")))
)
register(
    "fn07_iso_weekday", "select event_id, cast(isodow(ts) as int) weekday from events"
)(on_table("events", lambda: ("event_id", fn.iso_weekday("ts").alias("weekday"))))
register(
    "fn08_date_diff",
    """select event_id, date_diff('day', ts::date, date '2025-01-01') calendar_days,
    date_sub('day', ts, timestamp '2025-01-01') full_days from events""",
)(
    on_table(
        "events", lambda: ("event_id",
        fn.calendar_days(F.col("ts").cast("date"), F.lit(dt.date(2025, 1, 1))).alias("calendar_days"),
        fn.full_days("ts", F.lit(dt.date(2025, 1, 1))).alias("full_days")))
)
register(
    "fn09_date_add",
    """select event_id, ts - interval 2 days before_ts, cast(ts::date + 1 as date) next_day from events""",
)(
    on_table(
        "events", lambda: ("event_id", (F.col("ts") - F.make_dt_interval(days=F.lit(2))).alias("before_ts"),
        F.date_add(F.col("ts").cast("date"), 1).alias("next_day")))
)
register(
    "fn10_now_as_parameter",
    f"""select titulo_id, dt_vencimento < {oracle.NOW} is_due,
    dt_vencimento >= {oracle.NOW} - interval 2 days is_recent from titulos_receber""",
)(
    on_feed(
        "titulos_receber", lambda: ("titulo_id",
        (F.col("dt_vencimento") < as_of_date(AS_OF).cast("timestamp_ntz")).alias("is_due"),
        within_lookback("dt_vencimento", NOW).alias("is_recent")))
)
register(
    "fn11_sequence_unnest",
    """select l_orderkey, l_linenumber, unnest(generate_series(l_shipdate::date,
    l_shipdate::date + l_linenumber, interval 1 day))::date dia from lineitem""",
)(
    on_table(
        "lineitem", lambda: ("l_orderkey", "l_linenumber",
        F.explode(
            F.sequence(
                F.col("l_shipdate").cast("date"),
                F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber")),
            )
        ).alias("dia")))
)
register(
    "fn12_decimal_arithmetic",
    """select item_id, cast(abs(vlr_total - qtd_vendida * vlr_unitario) as decimal(38,6)) gap,
    cast(-vlr_total as decimal(18,2)) negated,
    cast(vlr_total + vlr_unitario as decimal(19,2)) total from itens_pedido""",
)(
    on_feed(
        "itens_pedido", lambda: ("item_id",
        F.abs(F.col("vlr_total") - F.col("qtd_vendida") * F.col("vlr_unitario"))
        .cast("decimal(38,6)").alias("gap"),
        (-F.col("vlr_total")).alias("negated"),
        (F.col("vlr_total") + F.col("vlr_unitario")).cast("decimal(19,2)").alias("total")))
)
register("fn13_md5", "select p_partkey, md5(p_name || '-' || p_brand) h from part")(
    on_table("part", lambda: ("p_partkey", fn.surrogate_key("p_name", "p_brand").alias("h")))
)
register(
    "fn14_parse_and_concat",
    """select o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::date d,
    strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') ts,
    year(o_orderdate) || '-' || o_orderpriority label from orders""",
)(
    on_table(
        "orders", lambda: ("o_orderkey",
        fn.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("d"),
        fn.parse_timestamp(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("ts"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.col("o_orderpriority")).alias("label")))
)
register(
    "fn15_unix_and_regexp",
    r"""select event_id, epoch_ms(event_id * 1000) ts,
    case when regexp_matches(props, '"k": ([0-9]+)') then regexp_extract(props, '"k": ([0-9]+)', 1) end k
    from events""",
)(
    on_table(
        "events", lambda: ("event_id", fn.unix_to_timestamp("event_id").alias("ts"),
        fn.extract_first("props", r'"k": ([0-9]+)', 1).alias("k")))
)
register(
    "fn16_arrays",
    """select p_partkey, list_contains(string_split(p_name, ' '), 'ring') has_ring,
    unnest(string_split(p_name, ' ')) word from part""",
)(
    on_table(
        "part", lambda: ("p_partkey", F.array_contains(F.split("p_name", " "), "ring").alias("has_ring"),
        F.explode(F.split("p_name", " ")).alias("word")))
)


# Incremental processing ------------------------------------------------------------------------

SALE_KEYS = ("tenant_id", "venda_id")


@register("in01_upsert", "select *, cast(year(dt_venda) as int) nr_ano from silver_dw_vendas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest merge into a table partitioned by tenant and sale year.

    The first load has every sale as pending. The batch brings the current rows
    of all closed sales together with outdated copies that must lose.
    """
    sales = models(spark, sf_dir)["silver_dw_vendas"].drop("_dbt_loaded_at")
    sales = sales.withColumn("nr_ano", F.year("dt_venda"))
    day = F.make_dt_interval(days=F.lit(1))
    pending = sales.withColumns(
        {
            "ds_status": F.lit("PENDENTE"),
            "updated_at": F.when(F.col("ds_status") == "PENDENTE", F.col("updated_at")).otherwise(
                F.col("updated_at") - day
            ),
        }
    )
    table = new_lake(spark).name("silver", "vendas")
    upsert(pending, table, SALE_KEYS, ("tenant_id", "nr_ano"), order_by="updated_at")
    closed = sales.filter(F.col("ds_status") != "PENDENTE")
    outdated = closed.withColumns(
        {"ds_status": F.lit("RASCUNHO"), "updated_at": F.col("updated_at") - day - day}
    )
    return upsert(
        closed.unionByName(outdated), table, SALE_KEYS, ("tenant_id", "nr_ano"), order_by="updated_at"
    )


@register("in02_full_then_incremental", "silver_dw_vendas")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build followed by an incremental run over the same feed changes nothing."""
    lake, feeds = new_lake(spark), Feeds(spark, sf_dir)
    for full_refresh in (True, False):
        built = build_layers(
            spark, feeds, lake, ["silver_dw_vendas"], full_refresh=full_refresh, now=NOW
        )
    return built["silver_dw_vendas"].drop("_dbt_loaded_at")


register(
    "in03_lookback",
    f"select * from fct_vendas where dt_venda >= {oracle.NOW} - interval 2 days",
)(
    lambda spark, sf_dir: models(spark, sf_dir)
    .build("fct_vendas", incremental=True, now=NOW)
    .drop("_dbt_loaded_at")
)


@register(
    "in04_high_water_mark",
    f"""select * from vendas where updated_at >= (
        select max(updated_at) - interval 1 day from vendas where updated_at < {oracle.NOW})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feeds(spark, sf_dir)["vendas"]
    stored = feed.filter(F.col("updated_at") < F.lit(NOW).cast("timestamp_ntz"))
    return since_high_water(feed, stored, "updated_at")


register(
    "in05_affected_groups",
    f"""select d.* from dre_contabil d semi join (
        select tenant_id, cd_tipo_conta, dt_competencia from fct_lancamentos
        where created_at >= {oracle.NOW} - interval 2 days)
        using (tenant_id, cd_tipo_conta, dt_competencia)""",
)(
    lambda spark, sf_dir: analytics.accounting_statement(
        models(spark, sf_dir), incremental="affected", now=NOW
    )
)

register(
    "in05_recent_entries_only",
    f"""select {oracle._sk('tenant_id', 'empresa_id', 'centro_custo_id', 'cd_tipo_conta', 'dt_competencia')}
        dre_contabil_sk, tenant_id, empresa_id, centro_custo_id, centro_custo_sk, cd_tipo_conta,
        dt_competencia, cast(strftime(dt_competencia, '%Y%m%d') as int) data_id,
        cast(sum(vlr_final) as decimal(18,2)) vlr_total
        from fct_lancamentos join (select tenant_id, empresa_id from dim_empresas) using (tenant_id)
        join (select tenant_id, centro_custo_id, centro_custo_sk from dim_centros_custos) using (tenant_id)
        where created_at >= {oracle.NOW} - interval 2 days group by all""",
)(
    lambda spark, sf_dir: analytics.accounting_statement(
        models(spark, sf_dir), incremental="recent_only", now=NOW
    )
)


@register(
    "in06_layered_build",
    "\nunion all\n".join(
        [f"select '{m}' item, 'rows' measure, count(*) n from {m}" for m in LAYER_OF]
        + [f"select '{c}' item, 'failures' measure, count(*) n from ({q})" for c, q in oracle.declared_tests()]
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers written in order, then row counts of every table and every declared test."""
    built = build_layers(
        spark, Feeds(spark, sf_dir), new_lake(spark), as_of=AS_OF, calendar=CALENDAR
    )
    rows = summarise({name: built[name] for name in LAYER_OF})
    failures = check_results(built)
    return rows.select(
        F.col("check_name").alias("item"), F.lit("rows").alias("measure"), F.col("failures").alias("n")
    ).unionByName(
        failures.select(
            F.col("check_name").alias("item"),
            F.lit("failures").alias("measure"),
            F.col("failures").alias("n"),
        )
    )


def two_days(spark: SparkSession, names: list[str], first: Mapping, second: Mapping) -> Models:
    """A full build of the first day's feeds, then an incremental run over the second day's."""
    lake = new_lake(spark)
    build_layers(spark, first, lake, names, now=DAY_ONE, as_of=AS_OF, calendar=CALENDAR)
    return build_layers(
        spark, second, lake, names, full_refresh=False, now=DAY_TWO, as_of=AS_OF, calendar=CALENDAR
    )


def every_other(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(2)) == 0


def arrived_now(df: DataFrame, which: Column) -> DataFrame:
    """Some rows come in on the second day; their own dates stay."""
    return df.withColumn("created_at", F.when(which, F.lit(DAY_TWO).cast("timestamp_ntz")).otherwise(F.col("created_at")))


@register("in08_late_settlements", "fct_titulo_financeiro")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all settlements arrive a day later with old dates: first ones, and second ones of settled titles."""
    feeds, late = Feeds(spark, sf_dir), every_other("baixa_id")
    first = Revised(feeds, baixas=lambda df: df.filter(~late))
    second = Revised(feeds, baixas=lambda df: arrived_now(df, late))
    built = two_days(spark, ["silver_dw_titulos_financeiros", "fct_titulo_financeiro"], first, second)
    return built["fct_titulo_financeiro"]


LEDGER = [
    "silver_dw_plano_contas", "silver_dw_lancamentos", "silver_dw_empresas", "silver_dw_centros_custos",
    "dim_plano_contas", "dim_empresas", "dim_centros_custos", "fct_lancamentos", "dre_contabil", "dre_gerencial",
]


def changed_ledger(spark: SparkSession, sf_dir: str) -> Models:
    """The first day lacks half of the entries of one type of id, has others in another month, and lacks companies."""
    feeds = Feeds(spark, sf_dir)
    late = every_other("lancamento_id")
    moved = late & (F.pmod(F.xxhash64("plano_conta_id", "lancamento_id"), F.lit(3)) > 0)
    before = F.when(moved, F.add_months("dt_competencia", -30).cast("timestamp_ntz")).otherwise(F.col("dt_competencia"))
    first = Revised(
        feeds,
        lancamentos=lambda df: df.filter(~late | moved).withColumn("dt_competencia", before),
        empresas=lambda df: df.filter(every_other("empresa_id")),
    )
    second = Revised(
        feeds,
        lancamentos=lambda df: arrived_now(df, late),
        empresas=lambda df: arrived_now(df, ~every_other("empresa_id")),
    )
    return two_days(spark, LEDGER, first, second)


@register(
    "in10_running_orders",
    """select * replace (
        case when ascii(right(ordem_producao_id, 1)) % 2 = 0 then created_at + interval 20 year else created_at end as created_at)
    from fct_ordens_producao""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of any age end on the second day, others run on: the merged fact equals a full one."""
    feeds = Feeds(spark, sf_dir)
    late = F.ascii(F.right("ordem_producao_id", F.lit(1))) % 2 == 0
    again = F.col("created_at") + F.make_ym_interval(F.lit(20))
    first = Revised(feeds, ordens_producao=lambda df: df.withColumn("dt_fim", F.when(~late, F.col("dt_fim"))))
    second = Revised(feeds, ordens_producao=lambda df: df.withColumn("created_at", F.when(late, again).otherwise(F.col("created_at"))))
    names = ["silver_dw_produtos", "silver_dw_ordens_producao", "dim_produtos", "fct_ordens_producao"]
    lake = new_lake(spark)
    # small tables: by tenant alone
    run = {"calendar": CALENDAR, "month_partitions": False}
    build_layers(spark, first, lake, names, now=DAY_ONE, as_of="1999-01-01", **run)
    built = build_layers(spark, second, lake, names, full_refresh=False, now=DAY_TWO, as_of=AS_OF, **run)
    return built["fct_ordens_producao"]


@register("in09_changed_ledger", "dre_contabil")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late and moved entries and new companies: the merged statement equals a full one."""
    return changed_ledger(spark, sf_dir)["dre_contabil"]


@register(
    "in07_stream_upsert",
    """select * from events qualify row_number() over (
        partition by user_id, event_type order by ts desc nulls last, event_id desc nulls last) = 1""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in files of arbitrary order; the newest per key survives."""
    landing = scratch_path(spark, "landing")
    events = Feeds(spark, sf_dir).source["events"]
    events.repartitionByRange(3, "ts").write.parquet(landing)
    table = new_lake(spark).name("silver", "events")
    feed = stream_feed(spark, landing, events.schema, max_files=1)
    upsert_stream(
        feed, table, ("user_id", "event_type"), "ts", scratch_path(spark, "stream"),
        partition_by=("event_type",),
    ).awaitTermination()
    return spark.table(table)


# Data quality ----------------------------------------------------------------------------------

@register("dq16_test_results", oracle.test_results())
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each declared and hand-written test of all models and of the feeds, with the number of failures.

    The layers are written first; the tests of single rows are counted by these writes.
    """
    feeds = Feeds(spark, sf_dir)
    built = build_layers(spark, feeds, new_lake(spark), as_of=AS_OF, calendar=CALENDAR, month_partitions=False)
    return checks.results(built, feeds)


register("dq01_not_null", "select * from silver_dw_ordens_compra where fornecedor_id is null")(
    lambda spark, sf_dir: quality.not_null(
        models(spark, sf_dir)["silver_dw_ordens_compra"], "fornecedor_id"
    ).drop("_dbt_loaded_at")
)
register(
    "dq01_null_counts",
    """select * from (
        select 'venda_id' column_name, count(*) n_records from silver_dw_expedicao where venda_id is null
        union all
        select 'transportadora_id', count(*) from silver_dw_expedicao where transportadora_id is null
        union all
        select 'dt_entrega_realizada', count(*) from silver_dw_expedicao where dt_entrega_realizada is null)
    where n_records > 0""",
)(
    lambda spark, sf_dir: quality.null_counts(
        models(spark, sf_dir)["silver_dw_expedicao"],
        ["venda_id", "transportadora_id", "dt_entrega_realizada"],
    )
)
register(
    "dq01_source_not_null",
    """select 'clientes.not_null' check_name, column_name, n_records from (
        select 'cliente_id' column_name, count(*) n_records from clientes where cliente_id is null
        union all select 'tenant_id', count(*) from clientes where tenant_id is null)
    where n_records > 0
    union all select 'vendas.not_null', 'venda_id', count(*) from vendas where venda_id is null
    having count(*) > 0""",
)(
    lambda spark, sf_dir: reduce(
        DataFrame.unionByName,
        [
            failing.select(F.lit(name).alias("check_name"), "*")
            for feed in checks.SOURCES
            for name, failing in checks.failing_rows(feed, Feeds(spark, sf_dir))
        ],
    )
)
register(
    "dq02_unique",
    """select vendedor_id, count(*) n_records from vendedores where vendedor_id is not null
    group by 1 having count(*) > 1""",
)(lambda spark, sf_dir: quality.unique(Feeds(spark, sf_dir)["vendedores"], "vendedor_id"))
register(
    "dq03_unique_combination",
    """select tenant_id, item_id, count(*) n_records from itens_pedido
    group by all having count(*) > 1""",
)(
    lambda spark, sf_dir: quality.unique_combination(
        Feeds(spark, sf_dir)["itens_pedido"], ["tenant_id", "item_id"]
    )
)
register(
    "dq04_accepted_values",
    """select cd_tipo_conta, count(*) n_records from fct_lancamentos
    where cd_tipo_conta not in ('ATIVO', 'PASSIVO', 'RECEITA', 'DESPESA') group by all""",
)(
    lambda spark, sf_dir: quality.accepted_values(
        models(spark, sf_dir)["fct_lancamentos"], "cd_tipo_conta", checks.ACCOUNT_TYPE
    )
)
register(
    "dq05_relationships",
    """select titulo_id, count(*) n_records from titulos_receber r
    where not exists (select 1 from baixas b where b.titulo_id = r.titulo_id) and titulo_id is not null
    group by all""",
)(
    lambda spark, sf_dir: quality.relationships(
        Feeds(spark, sf_dir)["titulos_receber"], "titulo_id", Feeds(spark, sf_dir)["baixas"], "titulo_id"
    )
)
register(
    "dq05_orphan_rows",
    """select * from vendedores v where filial_id is not null
    and not exists (select 1 from filiais f where f.filial_id = v.filial_id)""",
)(
    lambda spark, sf_dir: quality.orphan_rows(
        Feeds(spark, sf_dir)["vendedores"], "filial_id", Feeds(spark, sf_dir)["filiais"], "filial_id"
    )
)
register(
    "dq06_total_consistency",
    """select * from (select tenant_id, item_id, qtd_vendida, vlr_unitario, vlr_total,
        cast(abs(vlr_total - qtd_vendida * vlr_unitario) as decimal(38,6)) divergencia from fct_vendas)
    where divergencia > 0.01""",
)(
    lambda spark, sf_dir: quality.total_mismatch(
        models(spark, sf_dir)["fct_vendas"], ["tenant_id", "item_id"], "vlr_total", "qtd_vendida",
        "vlr_unitario",
    )
)
register(
    "dq07_tenant_leak",
    """select tenant_id, count(*) qt_registros_invalidos from dre_contabil
    where tenant_id <> 'unit_01' group by all""",
)(lambda spark, sf_dir: quality.tenant_leak(models(spark, sf_dir)["dre_contabil"], "unit_01"))
register(
    "dq07_tenant_leak_of_slice",
    """select tenant_id, count(*) qt_registros_invalidos from dre_contabil_unit_01
    where tenant_id <> 'unit_01' group by all""",
)(lambda spark, sf_dir: quality.tenant_leak(models(spark, sf_dir)["dre_contabil_unit_01"], "unit_01"))
register(
    "dq08_negative_lateness",
    """select tenant_id, titulo_id, tipo_titulo, nr_dias_atraso from controle_inadimplentes
    where nr_dias_atraso < 0""",
)(
    lambda spark, sf_dir: quality.negative_values(
        models(spark, sf_dir)["controle_inadimplentes"], silver.TITLE_KEYS, "nr_dias_atraso"
    )
)
register(
    "dq08_early_deliveries",
    "select tenant_id, expedicao_id, nr_dias_atraso from fct_expedicao where nr_dias_atraso < 0",
)(
    lambda spark, sf_dir: quality.negative_values(
        models(spark, sf_dir)["fct_expedicao"], ["tenant_id", "expedicao_id"], "nr_dias_atraso"
    )
)
register(
    "dq09_partition_gate",
    f"select count(*) n from ({DELIVERED}) where tenant_id = 'unit_01' and year = 1999",
)(
    lambda spark, sf_dir: quality.partition_rows(
        bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas"),
        "unit_01",
        dt.date(1999, 1, 1),
    )
)


@register(
    "dq10_missing_partitions",
    """select tenant_id, cast(y as int) as year, 1 as month, 1 as day
    from (values ('unit_01'), ('unit_02'), ('unit_03'), ('unit_04'), ('unit_05')) t(tenant_id),
         generate_series(1994, 2003) g(y)
    where (tenant_id, y) not in (select (tenant_id, year(created_at)) from vendas)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas")
    days = quality.expected_partitions(
        spark, TENANTS, dt.date(1994, 1, 1), dt.date(2003, 1, 1)
    ).filter("month = 1 and day = 1")
    return quality.missing_partitions(feed, days)


@register(
    "dq10_delivery_report",
    f"""select tenant_id, year, month, day, true as has_files, count(*) n_records
    from ({DELIVERED}) group by all""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas")
    return quality.delivery_report(feed).select(
        "tenant_id", "year", "month", "day", (F.col("files") > 0).alias("has_files"), "n_records"
    )


@register(
    "dq10_footer_report",
    f"""select tenant_id, year, month, day, true as has_files, count(*) n_records
    from ({DELIVERED}) group by all""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the footers of the files."""
    files = quality.delivered_footers(spark, deliver(spark, sf_dir), "comercial", "vendas")
    return quality.footer_report(files).select(
        "tenant_id", "year", "month", "day", (F.col("files") > 0).alias("has_files"), "n_records"
    )


@register(
    "dq10_contract_differences",
    """select 'unit_01' tenant_id, cast(2050 as int) as year, cast(1 as int) as month, cast(1 as int) as day, difference
    from (values ('missing vlr_total decimal(18,2)'), ('unexpected surprise string'),
                 ('venda_id: int instead of string')) t(difference)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bad delivery among the good ones."""
    root = deliver(spark, sf_dir)
    odd = spark.sql(
        """select 1 venda_id, cast(null as timestamp_ntz) dt_venda, 'c' cliente_id, 'v' vendedor_id, 's' status,
        cast(null as timestamp_ntz) created_at, cast(null as timestamp_ntz) updated_at, 'x' surprise,
        'unit_01' tenant_id, 2050 year, 1 month, 1 day"""
    )
    odd.write.mode("append").partitionBy("tenant_id", "year", "month", "day").parquet(bronze.table_path(root, "comercial", "vendas"))
    return quality.contract_differences(spark, root, "comercial", "vendas").drop("path")


register(
    "dq13_column_differences",
    """select * from (values ('status', 'missing'), ('surprise', 'unexpected')) t(column_name, difference)""",
)(
    lambda spark, sf_dir: quality.column_differences(
        Feeds(spark, sf_dir)["vendas"].drop("status").withColumn("surprise", F.lit("x")),
        ["tenant_id", *data_schema("comercial", "vendas").names],
    )
)


register(
    "dq11_freshness",
    """select make_date(max(year(created_at)), 1, 1) newest,
    date_diff('hour', make_date(max(year(created_at)), 1, 1)::timestamp, timestamp '2001-01-02 12:00:00') age_hours,
    'warn' status from vendas""",
)(
    lambda spark, sf_dir: quality.freshness(
        bronze.read_bronze(spark, deliver(spark, sf_dir), "comercial", "vendas"), "2001-01-02 12:00:00"
    )
)
def usual_volume(df: DataFrame, groups: list[str]) -> DataFrame:
    """Groups that leave the mean size of a group by more than a fifth."""
    usual = df.groupBy(*groups).count().agg(F.expr("sum(count) div count(*)")).first()[0] or 0
    return quality.volume_outside(df, groups, int(usual))


register(
    "dq12_volume",
    """select tenant_id, nr_ano, n_records from (
        select tenant_id, nr_ano, count(*) n_records, sum(count(*)) over () // count(*) over () usual
        from (select tenant_id, cast(year(dt_venda) as int) nr_ano from vendas) group by tenant_id, nr_ano)
    where n_records < usual * 0.8 or n_records > usual * 1.2""",
)(
    lambda spark, sf_dir: usual_volume(
        Feeds(spark, sf_dir)["vendas"].withColumn("nr_ano", F.year("dt_venda")), ["tenant_id", "nr_ano"]
    )
)
register(
    "dq13_value_range",
    "select * from lineitem where l_quantity < 5 or l_quantity > 45",
)(lambda spark, sf_dir: quality.outside_range(Feeds(spark, sf_dir).source["lineitem"], "l_quantity", 5, 45))
register(
    "dq13_row_count_range",
    "select count(*) n_records from events having count(*) not between 1 and 100",
)(lambda spark, sf_dir: quality.row_count_outside(Feeds(spark, sf_dir).source["events"], 1, 100))
register(
    "dq14_debits_equal_credits",
    """select tenant_id, dt_competencia,
    cast(coalesce(sum(vlr_lancamento) filter (cd_tipo_lancamento = 'DEBITO'), 0) as decimal(18,2)) vlr_debito,
    cast(coalesce(sum(vlr_lancamento) filter (cd_tipo_lancamento = 'CREDITO'), 0) as decimal(18,2)) vlr_credito
    from silver_dw_lancamentos group by all having vlr_debito <> vlr_credito""",
)(
    lambda spark, sf_dir: quality.unbalanced_entries(
        models(spark, sf_dir)["silver_dw_lancamentos"], "dt_competencia"
    )
)


@register(
    "dq15_reconcile",
    """select tenant_id, nm_ano_mes, a.v vlr_esquerda, b.v vlr_direita
    from (select tenant_id, strftime(created_at, '%Y-%m') nm_ano_mes, cast(sum(vlr_total) as decimal(18,2)) v
          from silver_dw_itens_pedido group by all) a
    full join (select tenant_id, strftime(dt_venda, '%Y-%m') nm_ano_mes,
                      cast(sum(vlr_total) as decimal(18,2)) v from fct_vendas group by all) b
    using (tenant_id, nm_ano_mes)
    where a.v is null or b.v is null or abs(a.v - b.v) > abs(a.v) * 0.001""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by shipping month against revenue by sale month."""
    built = models(spark, sf_dir)
    shipped = built["silver_dw_itens_pedido"].withColumn("nm_ano_mes", fn.month_label("created_at"))
    sold = built["fct_vendas"].withColumn("nm_ano_mes", fn.month_label("dt_venda"))
    return quality.reconcile(shipped, sold, ["tenant_id", "nm_ano_mes"], "vlr_total")


@register(
    "dq15_differing_rows",
    """select tenant_id, dia, vlr_total, cast(sum(l) as bigint) n_left, cast(sum(1 - l) as bigint) n_right
    from (select tenant_id, cast(created_at as date) dia, cast(vlr_total as decimal(18,2)) vlr_total, 1 l
          from silver_dw_itens_pedido
          union all
          select tenant_id, cast(dt_venda as date), cast(vlr_total as decimal(18,2)), 0 from fct_vendas)
    group by all having sum(l) <> sum(1 - l)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by shipping day that do not occur equally often by sale day.

    Both sides are read twice, so their three columns are written first instead of cleaning and joining twice.
    """
    built = models(spark, sf_dir)
    of = lambda name, day: materialise(
        built[name].select(
            "tenant_id", F.col(day).cast("date").alias("dia"), F.col("vlr_total").cast("decimal(18,2)").alias("vlr_total")
        ),
        name,
    )
    return quality.differing_rows(of("silver_dw_itens_pedido", "created_at"), of("fct_vendas", "dt_venda"))
