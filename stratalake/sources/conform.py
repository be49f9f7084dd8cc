"""Conform raw feeds to the columns the Silver layer reads.

Tenants name fields differently and some feeds lack columns. A mapping gives,
per target column, the candidate source names (first non-NULL wins) or a
function of the DataFrame for a derived value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources.contract import DATAMART_OF, data_schema

_DAY = ("year", "month", "day")

Rule = str | Sequence[str] | Callable[[DataFrame], Column]

_STRING = T.StringType()
_TS = T.TimestampNTZType()
_MONEY = T.DecimalType(18, 2)
_QTY = T.DecimalType(18, 4)


class ContractError(ValueError):
    """A feed cannot be brought to its contract."""


def _resolve(df: DataFrame, rule: Rule, dtype: T.DataType) -> Column:
    if callable(rule):
        return rule(df).cast(dtype)
    names = [rule] if isinstance(rule, str) else rule
    present = [F.col(n) for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast(dtype)
    return (present[0] if len(present) == 1 else F.coalesce(*present)).cast(dtype)


def conform(
    df: DataFrame,
    mapping: Mapping[str, Rule],
    schema: T.StructType,
    required: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` onto ``schema`` in one select; of the other columns those of ``keep`` stay."""
    for name in required:
        rule = mapping.get(name, name)
        names = [] if callable(rule) else [rule] if isinstance(rule, str) else list(rule)
        if names and not any(n in df.columns for n in names):
            raise ContractError(f"{name}: none of {names} is in {df.columns}")
    return df.select(
        *[_resolve(df, mapping.get(f.name, f.name), f.dataType).alias(f.name) for f in schema],
        *[c for c in keep if c in df.columns and c not in schema.fieldNames()],
    )


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[str]:
    """Human-readable differences in names and types (nullability is not part of the contract)."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    return (
        [f"missing {n} {t}" for n, t in want.items() if n not in have]
        + [f"unexpected {n} {t}" for n, t in have.items() if n not in want]
        + [f"{n}: {have[n]} instead of {t}" for n, t in want.items() if n in have and have[n] != t]
    )


def _fields(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in spec.items()])


def _amount(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(_MONEY)


def _entry_type(df: DataFrame) -> Column:
    """Debit/credit columns to a type label; feeds that already have one keep it."""
    positive = lambda name: F.coalesce(_amount(df, name), F.lit(0)) > 0
    label = F.when(positive("vlr_credito"), "CREDITO").when(positive("vlr_debito"), "DEBITO")
    return F.coalesce(F.col("cd_tipo_lancamento"), label) if "cd_tipo_lancamento" in df.columns else label


def _entry_value(df: DataFrame) -> Column:
    credit, debit = _amount(df, "vlr_credito"), _amount(df, "vlr_debito")
    split = F.when(F.coalesce(credit, F.lit(0)) > 0, credit).otherwise(debit)
    return F.coalesce(F.col("vlr_lancamento"), split) if "vlr_lancamento" in df.columns else split


def _settled_side(df: DataFrame) -> Column:
    """Settlements without a side: the invoice id prefix tells payables from receivables."""
    side = F.when(F.col("titulo_id").startswith("TPG-"), "PAGAR").when(
        F.col("titulo_id").startswith("TRC-"), "RECEBER"
    )
    return F.coalesce(F.col("tipo_titulo"), side) if "tipo_titulo" in df.columns else side


# The ten feeds whose raw contract differs from what Silver reads.
SILVER_INPUT: dict[str, tuple[T.StructType, dict[str, Rule]]] = {
    "centros_custos": (
        _fields({"tenant_id": _STRING, "centro_custo_id": _STRING, "nome": _STRING, "created_at": _TS}),
        {"nome": ("nome", "descricao")},
    ),
    "filiais": (
        _fields(
            {"tenant_id": _STRING, "filial_id": _STRING, "nome": _STRING, "cidade": _STRING,
             "uf": _STRING, "created_at": _TS}
        ),
        {},
    ),
    "expedicao": (
        _fields(
            {"tenant_id": _STRING, "expedicao_id": _STRING, "venda_id": _STRING,
             "transportadora_id": _STRING, "dt_expedicao": _TS, "dt_entrega_prevista": _TS,
             "dt_entrega_realizada": _TS, "ds_status": _STRING, "created_at": _TS, "updated_at": _TS}
        ),
        {"ds_status": ("ds_status", "status")},
    ),
    "materias_primas": (
        _fields(
            {"tenant_id": _STRING, "materia_prima_id": _STRING, "nome": _STRING,
             "unidade_medida": _STRING, "preco_unitario": _QTY, "created_at": _TS}
        ),
        {"nome": ("nome", "descricao"), "unidade_medida": ("unidade_medida", "unidade")},
    ),
    "orcamento": (
        _fields(
            {"tenant_id": _STRING, "orcamento_id": _STRING, "projeto_id": _STRING,
             "centro_custo_id": _STRING, "competencia": _TS, "vlr_orcado": _MONEY,
             "vlr_realizado": _MONEY, "created_at": _TS}
        ),
        {"competencia": ("competencia", "dt_competencia")},
    ),
    "ordens_producao": (
        _fields(
            {"tenant_id": _STRING, "ordem_producao_id": _STRING, "produto_id": _STRING,
             "qt_produzida": _QTY, "dt_inicio": _TS, "dt_fim": _TS, "ds_status": _STRING,
             "created_at": _TS}
        ),
        {"qt_produzida": ("qt_produzida", "qtd_produzida"), "ds_status": ("ds_status", "status")},
    ),
    "projetos": (
        _fields(
            {"tenant_id": _STRING, "projeto_id": _STRING, "nome": _STRING, "centro_custo_id": _STRING,
             "dt_inicio": _TS, "dt_fim": _TS, "created_at": _TS}
        ),
        {},
    ),
    "plano_contas": (
        _fields(
            {"tenant_id": _STRING, "plano_conta_id": _STRING, "codigo": _STRING, "descricao": _STRING,
             "tipo": _STRING, "created_at": _TS}
        ),
        {"plano_conta_id": ("plano_conta_id", "conta_id"), "codigo": ("codigo", "conta_id")},
    ),
    "lancamentos": (
        _fields(
            {"tenant_id": _STRING, "lancamento_id": _STRING, "plano_conta_id": _STRING,
             "cd_tipo_lancamento": _STRING, "dt_competencia": _TS, "vlr_lancamento": _MONEY,
             "historico": _STRING, "created_at": _TS}
        ),
        {
            "plano_conta_id": ("plano_conta_id", "conta_id"),
            "dt_competencia": ("dt_competencia", "dt_lancamento"),
            "cd_tipo_lancamento": _entry_type,
            "vlr_lancamento": _entry_value,
        },
    ),
    "baixas": (
        _fields(
            {"tenant_id": _STRING, "titulo_id": _STRING, "tipo_titulo": _STRING, "dt_baixa": _TS,
             "vlr_baixado": _MONEY, "created_at": _TS}
        ),
        {"tipo_titulo": _settled_side, "vlr_baixado": ("vlr_baixado", "vlr_baixa")},
    ),
}


def _identity(table: str) -> tuple[str, ...]:
    """Columns without which a feed cannot be merged: tenant, key and watermark."""
    schema = SILVER_INPUT[table][0] if table in SILVER_INPUT else data_schema(DATAMART_OF[table], table)
    key = next(n for n in schema.fieldNames() if n != "tenant_id")
    return ("tenant_id", key, "created_at")


def conform_feed(table: str, df: DataFrame) -> DataFrame:
    """Apply the standing mapping of ``table``.

    Tenant, key and watermark must be there under one of their names, and the delivery
    day stays, so that incremental runs can prune. A feed without a mapping must have
    the columns and types of its contract; more columns are allowed.
    """
    if table in SILVER_INPUT:
        schema, mapping = SILVER_INPUT[table]
        return conform(df, mapping, schema, _identity(table), keep=_DAY)
    wrong = [d for d in schema_differences(df.schema, data_schema(DATAMART_OF[table], table)) if not d.startswith("unexpected")]
    if wrong or "tenant_id" not in df.columns:
        raise ContractError(f"{table}: {wrong or 'no tenant_id'}")
    return df


def resolve_sides(settlements: DataFrame, payables: DataFrame, receivables: DataFrame) -> DataFrame:
    """Settlements with the missing ``tipo_titulo`` filled in from the side that has their title.

    What stays NULL has no title, or one on both sides: ``unresolved`` lists it, and no
    title takes its money.
    """
    title = ["tenant_id", "titulo_id"]
    known = payables.select(*title, F.lit("PAGAR").alias("_side")).unionByName(
        receivables.select(*title, F.lit("RECEBER").alias("_side"))
    )
    lost = settlements.filter(F.col("tipo_titulo").isNull())
    sides = (
        known.join(lost.select(*title).distinct(), title, "left_semi")
        .groupBy(*title)
        .agg(F.min("_side").alias("_side"), F.max("_side").alias("_other"))
        .filter("_side = _other")
        .drop("_other")
    )
    return (
        settlements.join(sides, title, "left")
        .withColumn("tipo_titulo", F.coalesce("tipo_titulo", "_side"))
        .select(*settlements.columns)
    )


def unresolved(settlements: DataFrame) -> DataFrame:
    return settlements.filter(F.col("tipo_titulo").isNull())
