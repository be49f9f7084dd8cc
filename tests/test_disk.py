"""What is shuffled and kept on disk: narrow rows, few of them, and only while a write needs them."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_of
from stratalake.functions import surrogate_key
from stratalake.operators import quality
from stratalake.operators import upsert as merge
from stratalake.operators.dedup import dedup_latest
from stratalake.plans import analytics, checks, facts
from stratalake.plans.build import build_layers
from stratalake.plans.catalogue import Models
from stratalake.session import RELEASE, shuffles_released
from stratalake.sources import tables
from workload.feeds import Feeds, Revised
from workload.registry import AS_OF, CALENDAR, every_other, models

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def depth_of(plan: str, what: str) -> int:
    """How deep below the root of a plan the first line with ``what`` lies."""
    return next(len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if what in line)


def physical(df) -> str:
    plan = plan_of(df)
    return plan[plan.index("== Physical Plan ==") :]


def test_versions_are_shuffled_without_a_hash_and_joined_where_they_are(rows, no_broadcast):
    df = rows("tenant_id string, k string, at int", ("a", "1", 1), ("a", "1", 2), ("b", "1", 1))
    latest = dedup_latest(df, ["tenant_id", "k"], "at")
    joined = latest.join(rows("tenant_id string, k string, w int", ("a", "1", 7)), ["tenant_id", "k"])
    plan = physical(joined)
    assert "xxhash64" not in plan
    # one for the versions, one for the other side
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert as_set(joined) == {("a", "1", 2, 7)}


def test_sales_are_enriched_before_their_lines(spark, no_broadcast):
    """the customer is found once a sale, not once a line with all that the line carries."""
    plan = models(spark, SMALL)
    optimized = analytics.enriched_sales(plan)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in optimized.splitlines() if "Join " in line]
    assert sum("Join Inner" in line for line in lines) == 1
    assert depth_of(optimized, "Join Inner") < min(depth_of("\n".join(lines), f"{c}#") for c in ("cliente_id", "produto_id"))


def test_enriched_sales_are_the_same_from_a_stored_fact(spark):
    """Sales without a customer, lines without a product and customers that are not known stay."""
    m = models(spark, SMALL)
    odd = F.col("venda_id").cast("int") % 3
    sales = m["silver_dw_vendas"].withColumn("cliente_id", F.when(odd == 0, None).when(odd == 1, "?").otherwise(F.col("cliente_id")))
    lines = m["silver_dw_itens_pedido"].withColumn("produto_id", F.when(odd != 1, F.col("produto_id")))
    m.stored = {"silver_dw_vendas": sales, "silver_dw_itens_pedido": lines}
    got = analytics.enriched_sales(m)
    stored = {**{n: m[n] for n in ("dim_calendrio", "dim_vendedores", "dim_produtos", "dim_clientes", "dim_empresas")}, "fct_vendas": m["fct_vendas"]}
    want = analytics.enriched_sales(stored)
    assert got.columns == want.columns and got.count() == lines.count() > 0
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.filter("nm_cliente is null").count() > 0 and got.filter("dsc_produto is null").count() > 0


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}


def test_builds_leave_no_shuffle_files(spark, lake):
    """what the write of a table has shuffled goes with it, not with the driver's next garbage collection."""
    before = shuffle_files(spark)
    build_layers(spark, Feeds(spark, SMALL), lake, ["silver_dw_orcamento", "silver_dw_vendas"], as_of=AS_OF, calendar=CALENDAR)
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert lake.table("silver", "silver_dw_vendas").count() > 0 and spark.conf.get(RELEASE[0], None) is None


def test_a_release_set_by_the_session_is_kept(spark):
    spark.conf.set(RELEASE[0], "false")
    try:
        with shuffles_released(spark):
            assert spark.conf.get(RELEASE[0]) == "false"
        assert spark.conf.get(RELEASE[0]) == "false"
    finally:
        spark.conf.unset(RELEASE[0])


SUPPLIED = ["silver_dw_fornecedores", "silver_dw_ordens_compra", "fct_ordens_compra"]


@pytest.mark.parametrize("few", [10_000, -1])
@pytest.mark.parametrize("by_month", [True, False])
def test_orders_of_unknown_suppliers_are_taken_away(spark, lake, monkeypatch, few, by_month):
    """the same rows whether they stay in their files or are joined and dealt out."""
    monkeypatch.setattr(facts, "FEW_UNKNOWN", few)
    feeds = Revised(Feeds(spark, SMALL), fornecedores=lambda df: df.filter(every_other("fornecedor_id")))
    run = {"as_of": AS_OF, "calendar": CALENDAR}
    want = Models(spark, feeds, **run)["fct_ordens_compra"].drop("_dbt_loaded_at")
    built = build_layers(spark, feeds, lake, SUPPLIED, month_partitions=by_month, **run)
    got = built["fct_ordens_compra"].select(*want.columns)
    assert 0 < got.count() < built["silver_dw_ordens_compra"].filter("fornecedor_id is not null").count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize(("fact", "names", "moved"), [
    ("fct_ordens_compra", SUPPLIED, False),
    ("fct_expedicao", ["silver_dw_transportadoras", "silver_dw_expedicao", "fct_expedicao"], False),
    ("fct_ordens_producao", ["silver_dw_produtos", "silver_dw_ordens_producao", "dim_produtos", "fct_ordens_producao"], False),
    ("fct_vendas", ["silver_dw_vendas", "silver_dw_itens_pedido", "fct_vendas"], True),
])
def test_hashed_keys_are_not_shuffled_for_the_write(spark, lake, monkeypatch, no_broadcast, fact, names, moved):
    """rows stay in the files of their month where they can, else they are dealt out before their keys are hashed."""
    plans, real = {}, tables.write_table

    def watch(df, name, partition_by=("tenant_id",), kept=False):
        arranged = tables.for_partitions(df, partition_by, kept)
        plans[name.split(".")[-1]] = arranged._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name, partition_by, kept)

    monkeypatch.setattr(tables, "write_table", watch)
    built = build_layers(spark, Feeds(spark, SMALL), lake, names, as_of=AS_OF, calendar=CALENDAR)
    assert ("RebalancePartitions" in plans[fact]) == moved, plans[fact]
    if moved:
        assert depth_of(plans[fact], "md5(") < depth_of(plans[fact], "RebalancePartitions"), plans[fact]
    want = models(spark, SMALL)[fact]
    same = [c for c in want.columns if c != "_dbt_loaded_at"]
    got = built[fact].select(*same)
    assert got.count() > 0 and got.exceptAll(want.select(*same)).isEmpty() and want.select(*same).exceptAll(got).isEmpty()


@pytest.mark.parametrize("buckets", [1, quality.BUCKETS])
def test_repeated_combinations_are_found_by_their_hashes(rows, buckets):
    data = [("x", 1, 0.0), ("x", 1, -0.0), (None, 2, 1.0), (None, 2, 1.0), ("y", None, 1.0), (None, None, None), (None, None, None), ("z", 1, 1.0)]
    df = rows("a string, b int, c double", *data)
    for columns in (["a"], ["a", "b"], ["a", "b", "c"]):
        want = as_set(quality.unique_combination(df, columns))
        assert as_set(quality.unique_combination(df, columns, stored=True, buckets=buckets)) == want and want
    assert as_set(quality.unique(df, "a", stored=True)) == {("x", 2)}


def test_unique_keys_of_a_stored_table_are_compared_by_short_hashes(spark, lake):
    """the texts themselves are shuffled only where a hash is repeated."""
    built = build_layers(spark, Feeds(spark, SMALL), lake, SUPPLIED, as_of=AS_OF, calendar=CALENDAR)
    failing = dict(checks.failing_rows("fct_ordens_compra", {**{n: built[n] for n in SUPPLIED}, "dim_fornecedores": built["dim_fornecedores"], "dim_calendrio": built["dim_calendrio"]}))
    stored = dict(checks.failing_rows("fct_ordens_compra", built))
    for name in ("fct_ordens_compra.unique(ordem_compra_sk)", "fct_ordens_compra.unique_combination(tenant_id,ordem_compra_id)"):
        assert stored[name].collect() == failing[name].collect() == []
        plan = stored[name]._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.index("== Initial Plan ==")]
        assert "hashpartitioning(ordem_compra" not in final and "hashpartitioning(tenant_id" not in final, final


def test_hashed_keys_are_not_shuffled_by_merges(spark, lake, rows, monkeypatch):
    """a column that follows from others is neither copied nor shuffled, and is in the table afterwards."""
    ddl, keys, by = "tenant_id string, k string, mes int, v string", ("tenant_id", "k"), ("tenant_id", "mes")
    t, seen = lake.name("gold", "t"), []
    hashed = {"sk": surrogate_key(*keys)}

    def batch(*data):
        return rows(ddl, *data).withColumns(hashed).select("sk", "tenant_id", "k", "mes", "v")

    arrange, copy = merge.for_partitions, merge.materialise
    monkeypatch.setattr(merge, "for_partitions", lambda df, *args: seen.append(df.columns) or arrange(df, *args))
    monkeypatch.setattr(merge, "materialise", lambda df, label="stage": seen.append(df.columns) or copy(df, label))
    merge.upsert(batch(("a", "1", 1, "x"), ("a", "2", 1, "y")), t, keys, by, derived=hashed)
    merge.upsert(batch(("a", "1", 2, "moved"), ("b", "1", 1, "new")), t, keys, by, derived=hashed)
    assert seen and not any("sk" in columns for columns in seen)
    assert as_set(spark.table(t).select("tenant_id", "k", "mes", "v")) == {("a", "1", 2, "moved"), ("a", "2", 1, "y"), ("b", "1", 1, "new")}
    assert spark.table(t).filter(F.col("sk") == surrogate_key(*keys)).count() == 3


def test_own_keys_of_all_facts_follow_from_their_rows(spark):
    built = models(spark, SMALL)
    for fact in facts.MODELS:
        for column, made in facts.derived(fact).items():
            assert built[fact].filter(~F.col(column).eqNullSafe(made)).isEmpty(), fact
