"""Typed contract of the Bronze layer.

One line per table: column names and types are fixed values shared with the
producers of the feeds. Types: s string, t zone-less timestamp,
m decimal(18,2) money, q decimal(18,4) quantity.
"""

from __future__ import annotations

from pyspark.sql import types as T

TENANTS = ("unit_01", "unit_02", "unit_03", "unit_04", "unit_05")

PARTITION_COLUMNS = ("tenant_id", "year", "month", "day")

MONEY = T.DecimalType(18, 2)
QUANTITY = T.DecimalType(18, 4)

_TYPES = {"s": T.StringType(), "t": T.TimestampNTZType(), "m": MONEY, "q": QUANTITY}

# Column lists of the 23 feeds, by datamart.
_TABLES: dict[str, dict[str, str]] = {
    "comercial": {
        "clientes": "cliente_id:s nome:s documento:s email:s cidade:s uf:s created_at:t updated_at:t",
        "vendedores": "vendedor_id:s nome:s filial_id:s created_at:t updated_at:t",
        "produtos": "produto_id:s descricao:s categoria:s preco_unitario:m created_at:t updated_at:t",
        "vendas": "venda_id:s dt_venda:t cliente_id:s vendedor_id:s vlr_total:m status:s "
        "created_at:t updated_at:t",
        "itens_pedido": "item_id:s venda_id:s produto_id:s qtd_vendida:q vlr_unitario:m vlr_total:m "
        "created_at:t",
    },
    "financeiro": {
        "titulos_pagar": "titulo_id:s fornecedor_id:s vlr_titulo:m dt_emissao:t dt_vencimento:t "
        "status:s created_at:t updated_at:t",
        "titulos_receber": "titulo_id:s cliente_id:s vlr_titulo:m dt_emissao:t dt_vencimento:t "
        "status:s created_at:t updated_at:t",
        "baixas": "baixa_id:s titulo_id:s vlr_baixa:m dt_baixa:t created_at:t",
    },
    "controladoria": {
        "centros_custos": "centro_custo_id:s descricao:s created_at:t",
        "projetos": "projeto_id:s nome:s centro_custo_id:s vlr_orcado:m created_at:t",
        "orcamento": "orcamento_id:s centro_custo_id:s dt_competencia:t vlr_orcado:m "
        "vlr_realizado:m created_at:t",
    },
    "logistica": {
        "filiais": "filial_id:s nome:s uf:s created_at:t",
        "transportadoras": "transportadora_id:s nome:s documento:s created_at:t",
        "expedicao": "expedicao_id:s venda_id:s transportadora_id:s dt_expedicao:t status:s "
        "created_at:t updated_at:t",
    },
    "suprimentos": {
        "fornecedores": "fornecedor_id:s nome:s documento:s created_at:t",
        "ordens_compra": "ordem_compra_id:s fornecedor_id:s dt_emissao:t vlr_total:m status:s "
        "created_at:t updated_at:t",
    },
    "corporativo": {
        "empresas": "empresa_id:s razao_social:s documento:s created_at:t",
        "funcionarios": "funcionario_id:s nome:s departamento_id:s cargo:s dt_admissao:t created_at:t",
        "departamentos": "departamento_id:s nome:s created_at:t",
    },
    "industrial": {
        "materias_primas": "materia_prima_id:s descricao:s unidade:s created_at:t",
        "ordens_producao": "ordem_producao_id:s produto_id:s qtd_produzida:q dt_inicio:t dt_fim:t "
        "status:s created_at:t",
    },
    "contabilidade": {
        "plano_contas": "conta_id:s descricao:s tipo:s created_at:t",
        "lancamentos": "lancamento_id:s conta_id:s dt_lancamento:t vlr_debito:m vlr_credito:m "
        "historico:s created_at:t",
    },
}


def struct(spec: str) -> T.StructType:
    """``"a:s b:m"`` to a StructType."""
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[code]) for name, code in fields])


REGISTRY: dict[tuple[str, str], T.StructType] = {
    (datamart, table): struct(spec)
    for datamart, tables in _TABLES.items()
    for table, spec in tables.items()
}

DATAMART_OF = {table: datamart for datamart, table in REGISTRY}


def data_schema(datamart: str, table: str) -> T.StructType:
    try:
        return REGISTRY[datamart, table]
    except KeyError:
        raise KeyError(f"no contract for {datamart}.{table}") from None


def partition_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("tenant_id", T.StringType())]
        + [T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")]
    )


def full_schema(datamart: str, table: str) -> T.StructType:
    return T.StructType(data_schema(datamart, table).fields + partition_schema().fields)
