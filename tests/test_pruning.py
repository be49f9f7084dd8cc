"""Month folders, key index and sums kept between runs: what is opened, and that the results stay whole."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_of
from stratalake.operators import key_index, upsert as merge
from stratalake.plans import analytics
from stratalake.plans.build import build_layers
from stratalake.plans.catalogue import Models
from stratalake.sources import months
from stratalake.sources.tables import write_table
from test_incremental import DAY2, LEDGER, OLD, ledger_feeds, statements

D, TS = Decimal, dt.datetime


@pytest.fixture
def events(spark, lake):
    """Twelve months of two tenants, a hundred keys each, and rows without a date."""
    day = F.expr("timestamp_ntz'2024-01-15' + make_interval(0, cast(id div 200 as int))")
    rows = spark.range(2400).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("tenant_id"), F.col("id").alias("k"), day.alias("at"), F.lit(1).alias("v")
    )
    rows = rows.unionByName(spark.sql("select 'a' tenant_id, 9000L + id k, cast(null as timestamp_ntz) at, 1 v from range(5)"))
    name = lake.name("silver", "events")
    write_table(months.with_month(rows, "at"), name, ("tenant_id", months.MONTH))
    return name


def filters_of(df) -> str:
    return " ".join(re.findall(r"PartitionFilters: \[(.*?)\], ", plan_of(df).split("== Physical Plan ==")[-1]))


def test_date_range_prunes_months(spark, events):
    low, high = F.lit(TS(2024, 5, 20)), F.lit(TS(2024, 8, 15))
    got = months.event_range(spark.table(events), "at", low, high)
    assert "_mes" in filters_of(got)
    assert {r[0] for r in got.select(months.MONTH).distinct().collect()} == {202406, 202407}
    plain = spark.table(events).drop(months.MONTH)
    assert as_set(got.select("k")) == as_set(months.event_range(plain, "at", low, high).select("k"))


def test_semi_join_prunes_months_at_run_time(spark, events):
    wanted = spark.sql("select 'a' tenant_id, timestamp_ntz'2024-03-15' at union all select 'a', null")
    wanted = merge.materialise(wanted, "wanted")
    got = months.semi_join_events(spark.table(events), wanted, "at")
    assert "dynamicpruning" in filters_of(got) and "_mes" in filters_of(got)
    plain = spark.table(events).drop(months.MONTH)
    assert as_set(got.select("k")) == as_set(months.semi_join_events(plain, wanted, "at").select("k"))
    assert got.count() == 100 + 5


def batch_of(spark, *rows):
    df = spark.createDataFrame([(t, k, at, v) for t, k, at, v in rows], "tenant_id string, k long, at timestamp_ntz, v int")
    return months.with_month(df, "at")


def test_index_opens_few_partitions_and_finds_all(spark, events):
    keys = ["tenant_id", "k"]
    key_index.refresh(spark, events, keys)
    # stored in March and without a date; the batch says July
    batch = batch_of(spark, ("a", 402, TS(2024, 7, 1), 5), ("a", 9001, TS(2024, 7, 1), 5), ("b", 402, TS(2024, 7, 1), 5))
    found = as_set(key_index.candidates(batch, events, keys))
    assert {("a", 202403), ("a", 0)} <= found
    assert len(found) <= 4, found
    # every stored key is found in its own partition
    everything = spark.table(events).select("tenant_id", "k", months.MONTH)
    for t, k, month in [tuple(r) for r in everything.sample(0.01, seed=3).collect()]:
        one = batch_of(spark, (t, k, OLD, 1))
        assert (t, month) in as_set(key_index.candidates(one, events, keys))


def test_indexed_merge_equals_a_plain_one(spark, lake, events):
    keys = ["tenant_id", "k"]
    twin = lake.name("silver", "twin")
    write_table(spark.table(events), twin, ("tenant_id", months.MONTH))
    first = batch_of(spark, ("a", 402, TS(2024, 7, 1), 5), ("b", 1, TS(2025, 2, 1), 6), ("c", 1, TS(2025, 2, 1), 7), ("a", 9001, OLD, 8))
    second = batch_of(spark, ("a", 402, TS(2024, 1, 1), 15), ("b", 1, None, 16), ("a", 4, TS(2024, 1, 2), 17))
    for batch in (first, second):
        merge.upsert(batch, events, keys, ("tenant_id", months.MONTH), indexed=True)
        merge.upsert(batch, twin, keys, ("tenant_id", months.MONTH))
        assert as_set(spark.table(events)) == as_set(spark.table(twin))
    assert as_set(spark.table(events).filter("k in (402, 9001, 4) and v > 1").select("tenant_id", "k", "v")) == {("a", 402, 15), ("a", 9001, 8), ("a", 4, 17)}


def test_files_written_by_others_are_opened(spark, events):
    keys = ["tenant_id", "k"]
    key_index.refresh(spark, events, keys)
    spark.createDataFrame([(70_000, TS(2024, 9, 15), 1, "b", 202409)], "k long, at timestamp_ntz, v int, tenant_id string, _mes int").write.insertInto(events, overwrite=False)
    batch = batch_of(spark, ("b", 70_000, TS(2024, 1, 1), 2))
    assert ("b", 202409) in as_set(key_index.candidates(batch, events, keys))
    merge.upsert(batch, events, keys, ("tenant_id", months.MONTH), indexed=True)
    assert as_set(spark.table(events).filter("k = 70000").select("v", months.MONTH)) == {(2, 202401)}


def test_statement_is_corrected_without_reading_the_ledger(spark, lake, rows):
    feb = TS(2025, 2, 1)
    first = ledger_feeds(rows, [("1", OLD, 10, OLD), ("2", feb, 1, OLD), ("3", feb, 7, OLD)])
    second = ledger_feeds(rows, [("1", feb, 10, DAY2), ("2", feb, 1, OLD), ("3", feb, 9, DAY2), ("4", feb, 2, DAY2)])
    build_layers(spark, first, lake, LEDGER, now="2025-01-20 12:00:00")
    built = build_layers(spark, second, lake, LEDGER, full_refresh=False, now="2025-01-21 12:00:00")
    assert statements(built) == statements(Models(spark, second))
    assert built.ledger.changes is not None
    assert as_set(built.ledger.totals().select("dt_competencia", "vlr_total", "qtd_lancamentos")) == {(feb.date(), D("22.00"), 4)}
    groups = merge.materialise(built.ledger.changes.select(*analytics.GROUP), "groups")
    plan = plan_of(analytics.accounting_statement(built, "affected", groups=groups))
    assert "aux_ledger_totals" in plan and "fct_lancamentos" not in plan


def test_sums_of_an_unknown_ledger_are_made_anew(spark, lake, rows):
    entries = [("1", OLD, 10, OLD), ("2", OLD, 1, OLD)]
    build_layers(spark, ledger_feeds(rows, entries), lake, LEDGER, now="2025-01-20 12:00:00")
    ledger = lake.name("gold", "fct_lancamentos")
    kept = merge.materialise(spark.table(ledger).filter("lancamento_id = '1'"), "kept")
    kept.write.insertInto(ledger, overwrite=True)  # by something that knows of no sums
    built = build_layers(spark, ledger_feeds(rows, [*entries, ("5", OLD, 3, DAY2)]), lake, LEDGER, full_refresh=False, now="2025-01-21 12:00:00")
    assert {r[3] for r in statements(built)[0]} == {D("13.00")}


def test_running_orders_are_evaluated_again(spark, lake, rows):
    names = ["silver_dw_produtos", "silver_dw_ordens_producao", "dim_produtos", "fct_ordens_producao"]

    def feeds(*orders):
        return {
            "produtos": rows(
                "tenant_id string, produto_id string, descricao string, categoria string, preco_unitario decimal(18,2),"
                "created_at timestamp_ntz, updated_at timestamp_ntz",
                ("u", "p", "x", "y", D(1), OLD, OLD),
            ),
            "ordens_producao": rows(
                "tenant_id string, ordem_producao_id string, produto_id string, qt_produzida decimal(18,4), dt_inicio date,"
                "dt_fim date, ds_status string, created_at timestamp_ntz",
                *[("u", i, "p", D(1), dt.date(2025, 1, 1), end, "x", at) for i, end, at in orders],
            ),
        }

    build_layers(spark, feeds(("1", None, OLD), ("2", None, OLD)), lake, names, now="2025-01-02 00:00:00", as_of="2025-01-02")
    second = feeds(("1", None, OLD), ("2", dt.date(2025, 1, 11), TS(2025, 1, 20)))
    built = build_layers(spark, second, lake, names, full_refresh=False, now="2025-01-20 12:00:00", as_of="2025-01-20")
    assert as_set(built["fct_ordens_producao"].select("ordem_producao_id", "nr_dias_producao")) == {("1", 19), ("2", 10)}
