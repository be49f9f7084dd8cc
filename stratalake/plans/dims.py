"""Gold dimensions: type 1, rebuilt in full, keyed by a hash of (tenant, natural key)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import date_key, iso_weekday, month_label, surrogate_key

Tables = Mapping[str, DataFrame]

# Default calendar range.
CALENDAR_START = dt.date(2024, 1, 1)
CALENDAR_END = dt.date(2027, 12, 31)

UNKNOWN_DEPARTMENT = "NAO_INFORMADO"


def calendar(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per day of a fixed range; shared by all tenants."""
    return calendar_days_of(
        spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("last_day"))
    )


def calendar_covering(dates: DataFrame, column: str) -> DataFrame:
    """Whole years around the dates that occur in ``column``."""
    span = dates.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return calendar_days_of(
        span.select(
            F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("first_day"),
            F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("last_day"),
        )
    )


def calendar_days_of(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("dt_data"))
    weekday = iso_weekday("dt_data")
    return days.select(
        date_key("dt_data").alias("data_id"),
        "dt_data",
        F.year("dt_data").alias("nr_ano"),
        F.month("dt_data").alias("nr_mes"),
        F.dayofmonth("dt_data").alias("nr_dia"),
        F.quarter("dt_data").alias("nr_trimestre"),
        weekday.alias("nr_dia_semana"),
        month_label("dt_data").alias("nm_ano_mes"),
        weekday.isin(6, 7).alias("fl_fim_de_semana"),
    )


# dimension -> (silver table, surrogate key column, natural key, drop the audit column)
_PLAIN = {
    "dim_clientes": ("silver_dw_clientes", "cliente_sk", "cliente_id", False),
    "dim_produtos": ("silver_dw_produtos", "produto_sk", "produto_id", False),
    "dim_vendedores": ("silver_dw_vendedores", "vendedor_sk", "vendedor_id", False),
    "dim_fornecedores": ("silver_dw_fornecedores", "fornecedor_sk", "fornecedor_id", False),
    "dim_empresas": ("silver_dw_empresas", "empresa_sk", "empresa_id", True),
    "dim_centros_custos": ("silver_dw_centros_custos", "centro_custo_sk", "centro_custo_id", True),
    "dim_plano_contas": ("silver_dw_plano_contas", "plano_conta_sk", "plano_conta_id", True),
}


def plain_dimension(name: str, silver: Tables) -> DataFrame:
    """A projection: no shuffle, unused columns are pruned through it."""
    table, sk, key, drop_audit = _PLAIN[name]
    rows = silver[table].withColumn(sk, surrogate_key("tenant_id", key))
    if drop_audit:
        rows = rows.drop("_dbt_loaded_at")
    return rows.select(sk, *[c for c in rows.columns if c != sk])


def employees(silver: Tables) -> DataFrame:
    """Employees with the department name denormalised."""
    staff = silver["silver_dw_funcionarios"].drop("_dbt_loaded_at")
    departments = silver["silver_dw_departamentos"].select(
        "tenant_id", "departamento_id", "nm_departamento"
    )
    return staff.join(departments, ["tenant_id", "departamento_id"], "left").select(
        surrogate_key("tenant_id", "funcionario_id").alias("funcionario_sk"),
        "tenant_id",
        "funcionario_id",
        "nm_funcionario",
        "departamento_id",
        F.coalesce("nm_departamento", F.lit(UNKNOWN_DEPARTMENT)).alias("nm_departamento"),
        "ds_cargo",
        "dt_admissao",
        "created_at",
    )


def build(
    name: str,
    spark: SparkSession,
    silver: Tables,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
) -> DataFrame:
    if name == "dim_calendrio":
        return calendar(spark, start, end)
    if name == "dim_funcionarios":
        return employees(silver)
    return plain_dimension(name, silver)


MODELS: tuple[str, ...] = ("dim_calendrio", *_PLAIN, "dim_funcionarios")
