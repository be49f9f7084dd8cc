"""The data tests declared for each model.

Most follow from a model's key: key columns are not NULL, the key is unique, a
surrogate key is not NULL and unique. Only what goes beyond that is listed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.plans.silver import TITLE_KEYS

# Accepted categories.
SALE_STATUS = ("FATURADA", "CANCELADA", "PENDENTE")
TITLE_KIND = ("PAGAR", "RECEBER")
TITLE_STATE = ("LIQUIDADO", "VENCIDO", "EM_ABERTO")
ACCOUNT_TYPE = ("ATIVO", "PASSIVO", "RECEITA", "DESPESA")
ENTRY_TYPE = ("CREDITO", "DEBITO")
CATEGORY = (
    "RECEITA_BRUTA", "DESPESA_OPERACIONAL", "ATIVO_CIRCULANTE", "PASSIVO_CIRCULANTE", "OUTROS",
)


@dataclass(frozen=True)
class Declared:
    """``key`` unique combination and not NULL; ``sk`` unique and not NULL; the rest as named.

    ``refs`` maps a column to (parent model, parent column). ``key_unique`` is off
    where only the NULL check of the key columns is declared.
    """

    key: tuple[str, ...] = ()
    sk: str | None = None
    required: tuple[str, ...] = ()
    refs: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    key_unique: bool = True
    nullable_key: tuple[str, ...] = ()

    @property
    def not_null(self) -> tuple[str, ...]:
        sk = (self.sk,) if self.sk else ()
        return (*sk, *[k for k in self.key if k not in self.nullable_key], *self.required)


def _t(*names: str) -> tuple[str, ...]:
    return ("tenant_id", *names)


def _ref(**parents: str) -> dict[str, tuple[str, str]]:
    """column=parent, where the parent column has the same name."""
    return {column: (parent, column) for column, parent in parents.items()}


_DAY = {"data_id": ("dim_calendrio", "data_id")}

DECLARED: dict[str, Declared] = {
    # silver
    "silver_dw_clientes": Declared(_t("cliente_id"), required=("nm_cliente",)),
    "silver_dw_vendedores": Declared(_t("vendedor_id")),
    "silver_dw_produtos": Declared(_t("produto_id"), required=("vlr_preco_unitario",)),
    "silver_dw_vendas": Declared(
        _t("venda_id"),
        required=("dt_venda", "cliente_id"),
        refs=_ref(cliente_id="silver_dw_clientes"),
        accepted={"ds_status": SALE_STATUS},
    ),
    "silver_dw_itens_pedido": Declared(
        _t("item_id"),
        required=("venda_id", "produto_id", "qtd_vendida"),
        refs=_ref(venda_id="silver_dw_vendas", produto_id="silver_dw_produtos"),
    ),
    "silver_dw_fornecedores": Declared(_t("fornecedor_id"), required=("nm_fornecedor",)),
    "silver_dw_ordens_compra": Declared(
        _t("ordem_compra_id"),
        required=("vlr_total", "fornecedor_id"),
        refs=_ref(fornecedor_id="silver_dw_fornecedores"),
    ),
    "silver_dw_empresas": Declared(_t("empresa_id"), required=("nm_empresa",)),
    "silver_dw_departamentos": Declared(_t("departamento_id"), required=("nm_departamento",)),
    "silver_dw_funcionarios": Declared(
        _t("funcionario_id"),
        required=("nm_funcionario", "departamento_id"),
        refs=_ref(departamento_id="silver_dw_departamentos"),
    ),
    "silver_dw_materias_primas": Declared(
        _t("materia_prima_id"), required=("nm_materia_prima", "vlr_preco_unitario")
    ),
    "silver_dw_ordens_producao": Declared(
        _t("ordem_producao_id"),
        required=("produto_id", "qt_produzida"),
        refs=_ref(produto_id="silver_dw_produtos"),
    ),
    "silver_dw_filiais": Declared(_t("filial_id"), required=("nm_filial",)),
    "silver_dw_transportadoras": Declared(_t("transportadora_id"), required=("nm_transportadora",)),
    "silver_dw_expedicao": Declared(
        _t("expedicao_id"),
        required=("venda_id", "transportadora_id"),
        refs=_ref(venda_id="silver_dw_vendas", transportadora_id="silver_dw_transportadoras"),
    ),
    "silver_dw_centros_custos": Declared(_t("centro_custo_id"), required=("nm_centro_custo",)),
    "silver_dw_projetos": Declared(
        _t("projeto_id"),
        required=("nm_projeto", "centro_custo_id"),
        refs=_ref(centro_custo_id="silver_dw_centros_custos"),
    ),
    "silver_dw_orcamento": Declared(
        _t("orcamento_id"),
        required=("projeto_id", "vlr_orcado", "vlr_realizado"),
        refs=_ref(projeto_id="silver_dw_projetos"),
    ),
    "silver_dw_titulos_financeiros": Declared(
        _t("titulo_id", "tipo_titulo"), required=("vlr_titulo",), accepted={"tipo_titulo": TITLE_KIND}
    ),
    "silver_dw_plano_contas": Declared(
        _t("plano_conta_id"), required=("cd_tipo_conta",), accepted={"cd_tipo_conta": ACCOUNT_TYPE}
    ),
    "silver_dw_lancamentos": Declared(
        _t("lancamento_id"),
        required=("plano_conta_id", "cd_tipo_lancamento", "vlr_lancamento"),
        refs=_ref(plano_conta_id="silver_dw_plano_contas"),
        accepted={"cd_tipo_lancamento": ENTRY_TYPE},
    ),
    # gold dimensions: the surrogate key carries uniqueness
    "dim_calendrio": Declared(sk="data_id", required=("dt_data",)),
    "dim_clientes": Declared(_t("cliente_id"), "cliente_sk", key_unique=False),
    "dim_produtos": Declared(_t("produto_id"), "produto_sk", key_unique=False),
    "dim_vendedores": Declared(_t("vendedor_id"), "vendedor_sk", key_unique=False),
    "dim_fornecedores": Declared(_t("fornecedor_id"), "fornecedor_sk", key_unique=False),
    "dim_empresas": Declared(
        _t("empresa_id"), "empresa_sk", required=("nm_empresa",), key_unique=False
    ),
    "dim_funcionarios": Declared(
        _t("funcionario_id"), "funcionario_sk", required=("nm_funcionario",)
    ),
    "dim_centros_custos": Declared(
        _t("centro_custo_id"), "centro_custo_sk", required=("nm_centro_custo",), key_unique=False
    ),
    "dim_plano_contas": Declared(
        _t("plano_conta_id"),
        "plano_conta_sk",
        required=("cd_tipo_conta",),
        accepted={"cd_tipo_conta": ACCOUNT_TYPE},
        key_unique=False,
    ),
    # gold facts
    "fct_vendas": Declared(
        _t("item_id"),
        "venda_item_sk",
        required=("venda_id", "cliente_sk", "produto_sk", "vendedor_sk", "data_id", "vlr_total"),
        refs={
            **_ref(cliente_sk="dim_clientes", produto_sk="dim_produtos", vendedor_sk="dim_vendedores"),
            **_DAY,
        },
    ),
    "fct_ordens_compra": Declared(
        _t("ordem_compra_id"),
        "ordem_compra_sk",
        required=("fornecedor_sk", "data_id", "vlr_total"),
        refs={**_ref(fornecedor_sk="dim_fornecedores"), **_DAY},
    ),
    "fct_ordens_producao": Declared(
        _t("ordem_producao_id"),
        "ordem_producao_sk",
        required=("produto_sk", "data_id", "qt_produzida", "nr_dias_producao"),
        refs={**_ref(produto_sk="dim_produtos"), **_DAY},
    ),
    "fct_expedicao": Declared(
        _t("expedicao_id"),
        "expedicao_sk",
        required=("venda_id", "transportadora_sk", "data_id"),
        refs=_DAY,
    ),
    "fct_orcamento_projetos": Declared(
        _t("orcamento_id"),
        "orcamento_sk",
        required=("centro_custo_sk", "data_id", "vlr_orcado", "vlr_realizado", "vlr_delta"),
        refs={**_ref(centro_custo_sk="dim_centros_custos"), **_DAY},
    ),
    "fct_titulo_financeiro": Declared(
        _t("titulo_id", "tipo_titulo"),
        "titulo_sk",
        required=("ds_situacao_titulo", "nr_dias_atraso", "vlr_titulo", "data_id"),
        accepted={"tipo_titulo": TITLE_KIND, "ds_situacao_titulo": TITLE_STATE},
    ),
    "fct_lancamentos": Declared(
        _t("lancamento_id"),
        "lancamento_sk",
        required=("plano_conta_sk", "data_id", "vlr_lancamento", "vlr_final"),
        refs=_ref(plano_conta_sk="dim_plano_contas"),
    ),
    # statements
    "dre_contabil": Declared(
        _t("empresa_id", "centro_custo_id", "cd_tipo_conta", "dt_competencia"),
        "dre_contabil_sk",
        required=("vlr_total",),
        accepted={"cd_tipo_conta": ACCOUNT_TYPE},
    ),
    "dre_gerencial": Declared(
        _t("empresa_id", "centro_custo_id", "ds_categoria", "dt_competencia"),
        "dre_gerencial_sk",
        required=("vlr_categoria",),
        accepted={"ds_categoria": CATEGORY},
        nullable_key=("centro_custo_id",),
    ),
    # platinum
    "controle_inadimplentes": Declared(
        _t("titulo_id", "tipo_titulo"),
        required=("nr_dias_atraso", "vlr_titulo"),
        accepted={"tipo_titulo": TITLE_KIND},
    ),
    **{
        f"dre_{kind}_{unit}": Declared(
            required=("tenant_id", value), accepted={"tenant_id": (unit,)}
        )
        for kind, value in (("contabil", "vlr_total"), ("gerencial", "vlr_categoria"))
        for unit in ("unit_01", "unit_02")
    },
    "dim_produtos_otimizada": Declared(required=("tenant_id", "produto_id", "dsc_produto")),
}

# Declared on the raw feeds.
SOURCES: dict[str, Declared] = {
    "clientes": Declared(required=("cliente_id", "tenant_id")),
    "vendas": Declared(required=("venda_id",)),
}


def count_declared() -> dict[str, int]:
    all_models = [*DECLARED.values(), *SOURCES.values()]
    return {
        "not_null": sum(len(d.not_null) for d in all_models),
        "unique": sum(d.sk is not None for d in all_models),
        "unique_combination": sum(bool(d.key) and d.key_unique for d in all_models),
        "accepted_values": sum(len(d.accepted) for d in all_models),
        "relationships": sum(len(d.refs) for d in all_models),
    }


def failing_rows(
    model: str, tables: Mapping[str, DataFrame], declared: Declared | None = None
) -> Iterator[tuple[str, DataFrame]]:
    """(check name, failing rows) for one model; the not-null checks share one scan."""
    declared = declared or DECLARED.get(model) or SOURCES[model]
    df = tables[model]
    clean = declared is DECLARED.get(model) and clean_rows(tables, model)
    stored = model in getattr(tables, "stored", ())
    if declared.not_null and clean:
        yield f"{model}.not_null", df.sparkSession.createDataFrame([], "column_name string, n_records bigint")
    elif declared.not_null:
        yield f"{model}.not_null", quality.null_counts(df, declared.not_null)
    if declared.sk:
        yield f"{model}.unique({declared.sk})", quality.unique(df, declared.sk, stored)
    if declared.key and declared.key_unique:
        name = f"{model}.unique_combination({','.join(declared.key)})"
        yield name, quality.unique_combination(df, declared.key, stored)
    for column, values in declared.accepted.items():
        failing = quality.accepted_values(df, column, values)
        yield f"{model}.accepted_values({column})", failing.sparkSession.createDataFrame([], failing.schema) if clean else failing
    for column, (parent, parent_column) in declared.refs.items():
        yield (
            f"{model}.relationships({column})",
            quality.relationships(df, column, tables[parent], parent_column),
        )


def singular(tables: Mapping[str, DataFrame], models: Iterable[str]) -> dict[str, DataFrame]:
    """The three hand-written tests, for the models that are selected."""
    found = {}
    if "fct_vendas" in models:
        found["fct_vendas.total_consistency"] = quality.total_mismatch(
            tables["fct_vendas"], ["tenant_id", "item_id"], "vlr_total", "qtd_vendida", "vlr_unitario"
        )
    if "dre_contabil_unit_01" in models:
        found["dre_contabil_unit_01.tenant_leak"] = quality.tenant_leak(
            tables["dre_contabil_unit_01"], "unit_01"
        )
    if "controle_inadimplentes" in models:
        found["controle_inadimplentes.negative_lateness"] = quality.negative_values(
            tables["controle_inadimplentes"], TITLE_KEYS, "nr_dias_atraso"
        )
    return found


def row_conditions(name: str, declared: Declared) -> list[tuple[str, Column]]:
    """(test, condition of a failing row) of the not-null and accepted-values tests."""
    tests = [(f"{name}.not_null({c})", F.col(c).isNull()) for c in declared.not_null]
    return tests + [(f"{name}.accepted_values({c})", ~F.col(c).isin(*v)) for c, v in declared.accepted.items()]


def row_tests(df: DataFrame, name: str, declared: Declared) -> DataFrame:
    """(test, failures) of all not-null and accepted-values tests of a table, in one scan."""
    tests = row_conditions(name, declared)
    counts = df.agg(*[F.count_if(bad).alias(f"t{i}") for i, (_, bad) in enumerate(tests)])
    rows = [F.struct(F.lit(n).alias("test"), F.col(f"t{i}").alias("failures")) for i, (n, _) in enumerate(tests)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.test", "r.failures")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation | None]:
    """``df`` with the tests of single rows counted by whatever job reads it next: the write of the table."""
    tests = row_conditions(name, DECLARED[name]) if name in DECLARED else []
    if not tests:
        return df, None
    seen = Observation(name)
    return df.observe(seen, *[F.count_if(bad).alias(f"t{i}") for i, (_, bad) in enumerate(tests)]), seen


def clean_rows(tables: Mapping[str, DataFrame], name: str) -> bool:
    """Whether the write of the table has seen all its rows and none that fails.

    Tasks that ran twice may count a row twice, so other counts than zero are taken from a scan.
    """
    seen = getattr(tables, "observed", {}).get(name)
    return seen is not None and not any(seen.values())


def results(
    tables: Mapping[str, DataFrame],
    feeds: Mapping[str, DataFrame],
    models: Iterable[str] | None = None,
    now: dt.datetime | str | None = None,
) -> DataFrame:
    """(test, failures): a row for each declared and hand-written test of the models and of the source feeds.

    Failures are rows for the tests of a row, keys or values for the others. Row tests that the write of a
    table has counted are not counted again. Feeds with delivery days have a freshness test: 1 if it is an error.
    """
    spark, parts, passed = None, [], []
    names = list(DECLARED if models is None else models)
    for name in names:
        spark = tables[name].sparkSession
        if clean_rows(tables, name):
            passed += [test for test, _ in row_conditions(name, DECLARED[name])]
        else:
            parts.append(row_tests(tables[name], name, DECLARED[name]))
        others = {n: df for n, df in failing_rows(name, tables) if ".not_null" not in n and ".accepted_values" not in n}
        if others:
            parts.append(quality.summarise(others).select(F.col("check_name").alias("test"), "failures"))
    hand_written = singular(tables, set(names) | (set(tables) if models is None else set()))
    if hand_written:
        parts.append(quality.summarise(hand_written).select(F.col("check_name").alias("test"), "failures"))
    parts += [row_tests(feeds[name], f"source.{name}", d) for name, d in SOURCES.items()]
    for name in SOURCES:
        if {"year", "month", "day"} <= set(feeds[name].columns):
            late = (F.col("status") == "error").cast("bigint").alias("failures")
            parts.append(quality.freshness(feeds[name], now).select(F.lit(f"source.{name}.freshness").alias("test"), late))
    if passed:
        zero = F.explode(F.array(*[F.lit(test) for test in passed])).alias("test")
        parts.append(spark.range(1).select(zero, F.lit(0).cast("bigint").alias("failures")))
    return reduce(DataFrame.unionByName, parts)
