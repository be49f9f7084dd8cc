"""The 23 business feeds as projections of the driver's tables.

Each feed is a projection of one table (``plano_contas`` is a small distinct),
so a query's cost is that of its own operators. Whole tables are used. Shared
conventions, mirrored by ``workload/oracle.py``:

* the tenant is unit_01..unit_05 by ``key % 5``; a nation's region follows the
  same rule, so cost centres (nations) and orders agree,
* customers, parts and carriers are shared by all tenants,
* text is delivered dirty (blanks, tabs, mixed case) and some values are NULL,
* ``lineitem`` repeats (l_orderkey, l_linenumber), ``vendedores``, ``projetos``
  and ``empresas`` repeat a few keys over all orders: input for keep-latest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.contract import TENANTS

BASE = "1995-01-01 00:00:00"


def tenant(key: str) -> Column:
    return F.concat(F.lit("unit_0"), (F.col(key) % 5 + 1).cast("string"))


def every_tenant() -> Column:
    return F.explode(F.array(*[F.lit(t) for t in TENANTS]))


# Tasks that repeat the rows of a table; a small file of many rows would else be one task.
SPREAD = 128


def repeated(rows: DataFrame, key: str, versions: int = 1) -> DataFrame:
    """``rows`` for every tenant, in ``versions``: columns tenant_id and version.

    Joined instead of exploded: Spark takes an explode for as small as its input, and would broadcast
    whatever is made of it.
    """
    names = F.array(*[F.lit(t) for t in TENANTS])
    n = len(TENANTS)
    copies = rows.sparkSession.range(0, n * versions, 1, 1).select(
        F.element_at(names, (F.col("id") % n + 1).cast("int")).alias("tenant_id"),
        F.floor(F.col("id") / n).cast("int").alias("version"),
    )
    return rows.repartition(SPREAD, key).crossJoin(F.broadcast(copies))


def text(key: str | Column) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def plus_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days.cast("int"))


def base_plus(days: Column) -> Column:
    return plus_days(F.lit(BASE).cast("timestamp_ntz"), days)


def month_start(c: str) -> Column:
    return F.date_trunc("month", F.col(c)).cast("timestamp_ntz")


def line_id() -> Column:
    """Repeated on purpose."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def entry_id() -> Column:
    """Unique per row at every scale."""
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        text(money("l_extendedprice")),
    )


def _clientes(t: Tables) -> DataFrame:
    rows = repeated(t["customer"], "c_custkey", versions=2)
    return rows.select(
        "tenant_id",
        text("c_custkey").alias("cliente_id"),
        F.concat(F.lit("\t "), F.lower("c_name"), F.lit(" v"), text("version"), F.lit("  ")).alias("nome"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("CPF "), F.col("c_name"))).alias("documento"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM ")).alias("email"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("cidade"),
        F.concat(F.lit(" n"), text("c_nationkey")).alias("uf"),
        base_plus(F.col("c_custkey") % 1000).alias("created_at"),
        base_plus(F.col("c_custkey") % 1000 + F.col("version")).alias("updated_at"),
    )


def _vendedores(t: Tables) -> DataFrame:
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        text(F.col("o_orderkey") % 1000).alias("vendedor_id"),
        F.concat(F.lit(" vendedor "), text("o_custkey")).alias("nome"),
        F.col("o_orderpriority").alias("filial_id"),
        F.lit(BASE).cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _produtos(t: Tables) -> DataFrame:
    rows = repeated(t["part"], "p_partkey", versions=2)
    return rows.select(
        "tenant_id",
        text("p_partkey").alias("produto_id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" v"), text("version"), F.lit(" ")).alias("descricao"),
        F.when(F.col("p_size") != 50, F.lower("p_type")).alias("categoria"),
        money("p_retailprice").alias("preco_unitario"),
        base_plus(F.col("p_partkey") % 1000).alias("created_at"),
        base_plus(F.col("p_partkey") % 1000 + F.col("version")).alias("updated_at"),
    )


def _vendas(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", " faturada")
        .when(F.col("o_orderstatus") == "O", "pendente ")
        .otherwise("cancelada")
    )
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        text("o_orderkey").alias("venda_id"),
        F.col("o_orderdate").alias("dt_venda"),
        text("o_custkey").alias("cliente_id"),
        text(F.col("o_orderkey") % 1000).alias("vendedor_id"),
        money("o_totalprice").alias("vlr_total"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        plus_days(F.col("o_orderdate"), F.lit(1)).alias("updated_at"),
    )


def _itens_pedido(t: Tables) -> DataFrame:
    exact = (money("l_extendedprice") * F.col("l_quantity").cast("decimal(18,4)")).cast("decimal(18,2)")
    return t["lineitem"].select(
        tenant("l_orderkey").alias("tenant_id"),
        line_id().alias("item_id"),
        text("l_orderkey").alias("venda_id"),
        text("l_partkey").alias("produto_id"),
        F.col("l_quantity").cast("decimal(18,4)").alias("qtd_vendida"),
        money("l_extendedprice").alias("vlr_unitario"),
        F.when(F.col("l_linenumber") == 7, money("l_extendedprice")).otherwise(exact).alias("vlr_total"),
        F.col("l_shipdate").alias("created_at"),
    )


def _fornecedores(t: Tables) -> DataFrame:
    return t["supplier"].select(
        tenant("s_suppkey").alias("tenant_id"),
        text("s_suppkey").alias("fornecedor_id"),
        F.concat(F.lit(" "), F.lower("s_name")).alias("nome"),
        F.col("s_name").alias("documento"),
        base_plus(F.col("s_suppkey") % 1000).alias("created_at"),
    )


def _ordens_compra(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("l_returnflag") == "A", "recebida ")
        .when(F.col("l_returnflag") == "N", " emitida")
        .otherwise("cancelada")
    )
    return t["lineitem"].select(
        tenant("l_suppkey").alias("tenant_id"),
        line_id().alias("ordem_compra_id"),
        F.when(F.col("l_discount") < 0.09, text("l_suppkey")).alias("fornecedor_id"),
        F.col("l_shipdate").alias("dt_emissao"),
        money("l_extendedprice").alias("vlr_total"),
        status.alias("status"),
        F.col("l_shipdate").alias("created_at"),
        plus_days(F.col("l_shipdate"), F.col("l_linenumber")).alias("updated_at"),
    )


def _titulos_receber(t: Tables) -> DataFrame:
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        text("o_orderkey").alias("titulo_id"),
        text("o_custkey").alias("cliente_id"),
        money("o_totalprice").alias("vlr_titulo"),
        F.col("o_orderdate").alias("dt_emissao"),
        _due(30).alias("dt_vencimento"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _due(days: int) -> Column:
    """Due dates have a time of day, so complete days differ from calendar days."""
    hours = (F.col("o_orderkey") % 24).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(days=F.lit(days), hours=hours)


def _titulos_pagar(t: Tables) -> DataFrame:
    """Same ids as the receivables: the kind must be part of the key."""
    share = (money("o_totalprice") * F.lit("0.05").cast("decimal(3,2)")).cast("decimal(18,2)")
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        text("o_orderkey").alias("titulo_id"),
        text("o_custkey").alias("fornecedor_id"),
        share.alias("vlr_titulo"),
        F.col("o_orderdate").alias("dt_emissao"),
        _due(60).alias("dt_vencimento"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _baixas(t: Tables) -> DataFrame:
    """Lines already invoiced ('F'): accepted ones settle receivables, returned ones payables."""
    settled = t["lineitem"].filter(
        (F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("A", "R")
    )
    return settled.select(
        tenant("l_orderkey").alias("tenant_id"),
        entry_id().alias("baixa_id"),
        text("l_orderkey").alias("titulo_id"),
        F.when(F.col("l_returnflag") == "A", "RECEBER").otherwise("PAGAR").alias("tipo_titulo"),
        money("l_extendedprice").alias("vlr_baixado"),
        F.col("l_shipdate").alias("dt_baixa"),
        F.col("l_shipdate").alias("created_at"),
    )


def _centros_custos(t: Tables) -> DataFrame:
    return t["nation"].select(
        tenant("n_nationkey").alias("tenant_id"),
        text("n_nationkey").alias("centro_custo_id"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("nome"),
        base_plus(F.col("n_nationkey")).alias("created_at"),
    )


def project_id() -> Column:
    return F.concat(text(F.col("o_orderkey") % 25), F.lit("/"), F.col("o_orderpriority"))


def _projetos(t: Tables) -> DataFrame:
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        project_id().alias("projeto_id"),
        F.concat(F.lit("projeto "), text("o_custkey"), F.lit(" ")).alias("nome"),
        text(F.col("o_orderkey") % 25).alias("centro_custo_id"),
        F.col("o_orderdate").alias("dt_inicio"),
        F.when(
            F.col("o_orderstatus") != "O", plus_days(F.col("o_orderdate"), F.lit(90))
        ).alias("dt_fim"),
        F.col("o_orderdate").alias("created_at"),
    )


def _orcamento(t: Tables) -> DataFrame:
    factor = F.when(F.col("o_orderstatus") == "F", F.lit("1.1")).otherwise(F.lit("0.9"))
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        text("o_orderkey").alias("orcamento_id"),
        project_id().alias("projeto_id"),
        text(F.col("o_orderkey") % 25).alias("centro_custo_id"),
        month_start("o_orderdate").alias("competencia"),
        money("o_totalprice").alias("vlr_orcado"),
        (money("o_totalprice") * factor.cast("decimal(2,1)")).cast("decimal(18,2)").alias("vlr_realizado"),
        F.col("o_orderdate").alias("created_at"),
    )


def _filiais(t: Tables) -> DataFrame:
    return t["nation"].select(
        tenant("n_nationkey").alias("tenant_id"),
        text("n_nationkey").alias("filial_id"),
        F.concat(F.lit("filial "), F.lower("n_name")).alias("nome"),
        F.concat(F.lit("cidade "), text("n_nationkey"), F.lit("\t")).alias("cidade"),
        F.concat(F.lit("r"), text("n_regionkey")).alias("uf"),
        base_plus(F.col("n_nationkey")).alias("created_at"),
    )


def _transportadoras(t: Tables) -> DataFrame:
    return repeated(t["supplier"], "s_suppkey").select(
        "tenant_id",
        text("s_suppkey").alias("transportadora_id"),
        F.concat(F.lit("transportes "), F.col("s_name")).alias("nome"),
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("00.0/"), text("s_suppkey"))).alias("documento"),
        base_plus(F.col("s_suppkey") % 1000).alias("created_at"),
    )


def _expedicao(t: Tables) -> DataFrame:
    shipped = F.col("l_shipdate")
    return t["lineitem"].select(
        tenant("l_orderkey").alias("tenant_id"),
        line_id().alias("expedicao_id"),
        text("l_orderkey").alias("venda_id"),
        F.when(F.col("l_tax") > 0, text("l_suppkey")).alias("transportadora_id"),
        shipped.alias("dt_expedicao"),
        plus_days(shipped, F.lit(25)).alias("dt_entrega_prevista"),
        F.when(F.col("l_linestatus") == "F", plus_days(shipped, F.col("l_quantity"))).alias(
            "dt_entrega_realizada"
        ),
        F.when(F.col("l_linestatus") == "F", " entregue").otherwise("em rota ").alias("ds_status"),
        shipped.alias("created_at"),
        plus_days(shipped, F.lit(1)).alias("updated_at"),
    )


def _empresas(t: Tables) -> DataFrame:
    return t["orders"].select(
        tenant("o_orderkey").alias("tenant_id"),
        F.col("o_orderpriority").alias("empresa_id"),
        F.concat(F.lit(" empresa "), F.lower("o_orderpriority"), F.lit(" ")).alias("razao_social"),
        F.concat(F.lit("CNPJ "), text("o_orderkey")).alias("documento"),
        F.col("o_orderdate").alias("created_at"),
    )


def _departamentos(t: Tables) -> DataFrame:
    return t["nation"].select(
        tenant("n_nationkey").alias("tenant_id"),
        text("n_nationkey").alias("departamento_id"),
        F.concat(F.lit("depto "), F.lower("n_name")).alias("nome"),
        base_plus(F.col("n_nationkey")).alias("created_at"),
    )


def _funcionarios(t: Tables) -> DataFrame:
    return t["customer"].select(
        tenant("c_nationkey").alias("tenant_id"),
        text("c_custkey").alias("funcionario_id"),
        F.concat(F.lower("c_name"), F.lit(" ")).alias("nome"),
        F.when(F.col("c_acctbal") >= 0, text("c_nationkey")).alias("departamento_id"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("cargo"),
        base_plus(F.col("c_custkey") % 2000).alias("dt_admissao"),
        base_plus(F.col("c_custkey") % 2000).alias("created_at"),
    )


def _materias_primas(t: Tables) -> DataFrame:
    return t["part"].select(
        tenant("p_partkey").alias("tenant_id"),
        text("p_partkey").alias("materia_prima_id"),
        F.concat(F.lit(" "), F.col("p_name")).alias("nome"),
        F.lower("p_brand").alias("unidade_medida"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("preco_unitario"),
        base_plus(F.col("p_partkey") % 1000).alias("created_at"),
    )


def _ordens_producao(t: Tables) -> DataFrame:
    done = F.col("l_linestatus") == "F"
    return t["lineitem"].select(
        tenant("l_orderkey").alias("tenant_id"),
        line_id().alias("ordem_producao_id"),
        text("l_partkey").alias("produto_id"),
        F.col("l_quantity").cast("decimal(18,4)").alias("qt_produzida"),
        F.col("l_shipdate").alias("dt_inicio"),
        F.when(done, plus_days(F.col("l_shipdate"), F.col("l_linenumber"))).alias("dt_fim"),
        F.when(done, "concluida ").otherwise(" em andamento").alias("ds_status"),
        F.col("l_shipdate").alias("created_at"),
    )


def account_id() -> Column:
    return F.concat(F.col("l_returnflag"), F.lit("."), F.col("l_linestatus"))


def _plano_contas(t: Tables) -> DataFrame:
    """Six accounts per tenant; PATRIMONIO is not an accepted type and falls into OUTROS."""
    accounts = t["lineitem"].select(account_id().alias("conta")).distinct()
    kind = (
        F.when(F.col("conta").isin("A.F", "R.F"), " receita")
        .when(F.col("conta") == "A.O", "despesa ")
        .when(F.col("conta") == "N.F", "ativo")
        .when(F.col("conta") == "N.O", "passivo")
        .otherwise("patrimonio")
    )
    return accounts.withColumn("tenant_id", every_tenant()).select(
        "tenant_id",
        F.col("conta").alias("plano_conta_id"),
        F.concat(F.lit(" "), F.lower("conta")).alias("codigo"),
        F.concat(F.lit("conta "), F.col("conta")).alias("descricao"),
        kind.alias("tipo"),
        F.lit(BASE).cast("timestamp_ntz").alias("created_at"),
    )


def _lancamentos(t: Tables) -> DataFrame:
    kind = F.when(F.col("l_tax") > 0.04, " credito").when(F.col("l_tax") > 0, "debito ")
    return t["lineitem"].select(
        tenant("l_orderkey").alias("tenant_id"),
        entry_id().alias("lancamento_id"),
        account_id().alias("plano_conta_id"),
        kind.alias("cd_tipo_lancamento"),
        month_start("l_shipdate").alias("dt_competencia"),
        money("l_extendedprice").alias("vlr_lancamento"),
        F.when(
            F.col("l_returnflag") != "N", F.concat(F.lit("pedido "), text("l_orderkey"))
        ).alias("historico"),
        F.col("l_shipdate").alias("created_at"),
    )


class Tables(Mapping[str, DataFrame]):
    """Lazily opened driver tables."""

    NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


FEEDS = {
    "clientes": _clientes,
    "vendedores": _vendedores,
    "produtos": _produtos,
    "vendas": _vendas,
    "itens_pedido": _itens_pedido,
    "titulos_pagar": _titulos_pagar,
    "titulos_receber": _titulos_receber,
    "baixas": _baixas,
    "centros_custos": _centros_custos,
    "projetos": _projetos,
    "orcamento": _orcamento,
    "filiais": _filiais,
    "transportadoras": _transportadoras,
    "expedicao": _expedicao,
    "fornecedores": _fornecedores,
    "ordens_compra": _ordens_compra,
    "empresas": _empresas,
    "funcionarios": _funcionarios,
    "departamentos": _departamentos,
    "materias_primas": _materias_primas,
    "ordens_producao": _ordens_producao,
    "plano_contas": _plano_contas,
    "lancamentos": _lancamentos,
}


class Revised(Mapping[str, DataFrame]):
    """Feeds of another day: some of them changed by a function of the original."""

    def __init__(self, base: Mapping[str, DataFrame], **changes: Callable[[DataFrame], DataFrame]) -> None:
        self.base, self.changes = base, changes

    def __getitem__(self, name: str) -> DataFrame:
        feed = self.base[name]
        return self.changes[name](feed) if name in self.changes else feed

    def __iter__(self) -> Iterator[str]:
        return iter(self.base)

    def __len__(self) -> int:
        return len(self.base)


class Feeds(Mapping[str, DataFrame]):
    """Business feeds by name, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.source = Tables(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return FEEDS[name](self.source)

    def __iter__(self) -> Iterator[str]:
        return iter(FEEDS)

    def __len__(self) -> int:
        return len(FEEDS)
