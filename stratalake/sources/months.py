"""Month folders of event tables.

A table of events is stored by tenant and by the month of an event date that hardly ever changes. The
month is a generated column that its readers do not see: a range of that date becomes a range of months
as well, and a join on the date one on the month, so that Spark opens the folders in question only.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "_mes"

EVENT_DATE = {
    "silver_dw_vendas": "dt_venda",
    "silver_dw_itens_pedido": "created_at",
    "silver_dw_ordens_compra": "dt_emissao",
    "silver_dw_ordens_producao": "dt_inicio",
    "silver_dw_expedicao": "dt_expedicao",
    "silver_dw_titulos_financeiros": "dt_emissao",
    "silver_dw_lancamentos": "dt_competencia",
    "fct_vendas": "dt_venda",
    "fct_ordens_compra": "dt_emissao",
    "fct_ordens_producao": "dt_inicio",
    "fct_expedicao": "dt_expedicao",
    "fct_titulo_financeiro": "dt_emissao",
    "fct_lancamentos": "dt_competencia",
    "dre_contabil": "dt_competencia",
}


def month_of(date: Column | str) -> Column:
    """202501 for a day of January 2025; 0 without a date, so that the month is never NULL."""
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0))


def with_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn(MONTH, month_of(date))


def by_month(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """The table with its month where it is stored by month, else as it is."""
    stored = getattr(tables, "by_month", None)
    return stored(name) if stored else tables[name]


def event_range(df: DataFrame, date: str, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Rows with ``low <= date < high``; both bounds are constants of the query, rows without a date go.

    The month, if the table has one, must be that of ``date``.
    """
    keep = F.col(date).isNotNull()
    if low is not None:
        keep = keep & (F.col(date) >= low)
    if high is not None:
        keep = keep & (F.col(date) < high)
    if MONTH in df.columns:
        if low is not None:
            keep = keep & (F.col(MONTH) >= month_of(low))
        if high is not None:
            keep = keep & (F.col(MONTH) <= month_of(high))
    return df.filter(keep)


def semi_join_events(df: DataFrame, wanted: DataFrame, date: str, how: str = "left_semi") -> DataFrame:
    """``df`` semi (or anti) joined with ``wanted`` on all columns of ``wanted``, ``date`` among them; NULLs match.

    The months are compared too. Where ``wanted`` is small enough to be broadcast, Spark opens the
    folders of its months only; elsewhere the condition changes nothing.
    """
    renamed = wanted.select(*[F.col(c).alias(f"_w_{c}") for c in wanted.columns])
    same = reduce(and_, [df[c].eqNullSafe(renamed[f"_w_{c}"]) for c in wanted.columns])
    if MONTH in df.columns:
        # the bound, true for every row, is what lets Spark take this side for a selective one
        renamed = renamed.withColumn("_w_month", month_of(f"_w_{date}")).filter("_w_month >= 0")
        same = same & (df[MONTH] == renamed["_w_month"])
    return df.join(renamed, same, how)
