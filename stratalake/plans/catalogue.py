"""All models by name, resolved lazily through their inputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from stratalake.plans import analytics, dims, facts, silver

LAYER_OF: dict[str, str] = {
    **{name: "silver" for name in silver.MODELS},
    **{name: "gold" for name in (*dims.MODELS, *facts.MODELS, *analytics.ANALYTICS)},
    **{name: "platinum" for name in analytics.PLATINUM},
}

# Build order of the layers; within a group the models are independent.
BUILD_ORDER: tuple[tuple[str, ...], ...] = (
    silver.MODELS,
    dims.MODELS,
    facts.MODELS,
    ("dre_contabil",),
    ("dre_gerencial",),
    analytics.PLATINUM,
)

KEYS: dict[str, tuple[str, ...]] = {
    **{name: silver.keys_of(name) for name in silver.MODELS},
    **facts.KEYS,
    "dre_contabil": analytics.STATEMENT_KEYS,
    "dre_gerencial": analytics.MANAGERIAL_KEYS,
}


class Models(Mapping[str, DataFrame]):
    """Name to lazy DataFrame, from feeds or from already stored tables.

    ``stored`` takes precedence: a model whose input is stored reads the table
    instead of recomputing the input's plan.
    """

    def __init__(
        self,
        spark: SparkSession,
        feeds: Mapping[str, DataFrame],
        as_of: dt.date | str | None = None,
        calendar: tuple[dt.date, dt.date] = (dims.CALENDAR_START, dims.CALENDAR_END),
        stored: Mapping[str, DataFrame] | None = None,
        delivered_from: dt.date | None = None,
    ) -> None:
        self.spark, self.feeds, self.as_of, self.calendar = spark, feeds, as_of, calendar
        self.stored = stored if stored is not None else {}
        self.delivered_from = delivered_from
        # set by a build: failing rows of the tests that the write of a table has counted
        self.observed: dict[str, dict[str, int]] = {}
        # set by a build: the stored sums of the ledger, if they are up to date
        self.ledger_totals: DataFrame | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.stored:
            return self.stored[name]
        return self.build(name)

    def by_month(self, name: str) -> DataFrame:
        """Like an item, with the month column where the table is stored by month."""
        if name in self.stored and hasattr(self.stored, "by_month"):
            return self.stored.by_month(name)
        return self[name]

    def build(
        self,
        name: str,
        incremental: bool = False,
        now: dt.datetime | str | None = None,
        current: DataFrame | None = None,
        groups: DataFrame | None = None,
        small_chart: bool = False,
        unknown: DataFrame | None = None,
        arrange: facts.Attributes = None,
    ) -> DataFrame:
        """Plan of one model; ``current`` is its stored content, if an incremental run has one.

        ``groups`` are the groups of the accounting statement to compute anew; the last three are for the
        write of a fact in a full build (``facts.build``).
        """
        if name in silver.MODELS:
            return silver.build(name, self.feeds, incremental, now, self.delivered_from)
        if name in dims.MODELS:
            return dims.build(name, self.spark, self, *self.calendar)
        if name in facts.MODELS:
            settled = None
            if name == "fct_titulo_financeiro" and incremental and "baixas" in self.feeds:
                settled = silver.recently_settled(self.feeds, now, self.delivered_from)
            return facts.build(name, self, incremental, now, self.as_of, current, settled, small_chart, unknown, arrange)
        if name == "dre_contabil":
            return analytics.accounting_statement(self, "affected" if incremental else None, now, groups=groups)
        if name == "dre_gerencial":
            return analytics.managerial_statement(self)
        return analytics.build_platinum(name, self)

    def __iter__(self) -> Iterator[str]:
        return iter(LAYER_OF)

    def __len__(self) -> int:
        return len(LAYER_OF)
