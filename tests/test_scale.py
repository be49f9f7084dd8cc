"""Plans that hold on large tables: no hot task, no broadcast of what only looks small."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stratalake.operators import upsert as merge
from stratalake.plans.build import build_layers
from stratalake.session import HASH_JOINS, joined_by_hashes
from stratalake.sources import tables
from workload.feeds import SPREAD, Feeds
from workload.registry import AS_OF, CALENDAR, LEDGER, QUERIES

SMALL = "/root/testdata/sf0.001"


def size_estimate(df) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@pytest.mark.parametrize("feed", ["clientes", "produtos", "transportadoras"])
def test_repeated_feeds_are_made_by_many_tasks(spark, feed):
    assert Feeds(spark, SMALL)[feed].rdd.getNumPartitions() == SPREAD


@pytest.mark.parametrize(("feed", "table", "times"), [("clientes", "customer", 10), ("produtos", "part", 10), ("transportadoras", "supplier", 5)])
def test_repeated_feeds_are_not_taken_for_small(spark, feed, table, times):
    feeds = Feeds(spark, SMALL)
    assert feeds[feed].count() == times * feeds.source[table].count()
    assert size_estimate(feeds[feed]) >= times * size_estimate(feeds.source[table])


@pytest.mark.parametrize("query", ["gf03_fct_ordens_producao", "pl09_enriched_sales"])
def test_dimensions_are_broadcast_by_measured_size_only(spark, query):
    """On the small tables a join of products may be a broadcast, but not one that was planned from file sizes."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    # a thirtieth of what the 20,000 products of sf0.1 really take, twice their file
    spark.conf.set(key, "400k")
    try:
        plan = QUERIES[query](spark, "/root/testdata/sf0.1")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set(key, before)
    joins = [line for line in plan.splitlines() if "Join" in line and "produto_id" in line]
    assert joins and all("SortMergeJoin" in line for line in joins), joins


def test_enriched_sales_shuffle_no_hashes(spark):
    """Hashed keys are made after the last join."""
    plan = QUERIES["pl09_enriched_sales"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last_join = max(i for i, line in enumerate(plan) if "Join" in line)
    first_join = min(i for i, line in enumerate(plan) if "Join" in line)
    hashes = [i for i, line in enumerate(plan) if " md5(" in line and any(k in line for k in ("cliente_sk", "produto_sk", "vendedor_sk"))]
    assert hashes and max(hashes) < first_join < last_join


def test_differing_rows_reads_written_sides(spark):
    """The cleaned lines and the fact are computed once; the two passes read what was written."""
    plan = QUERIES["dq15_differing_rows"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "Window" not in plan


def files_of(spark, table):
    return {tuple(r) for r in spark.table(table).select("_metadata.file_name", "_metadata.file_size").distinct().collect()}


MONTHLY = "tenant_id string, k string, mes int, v string"


def test_merged_partitions_are_moved_not_written_again(spark, lake, rows, monkeypatch):
    """The files of the staging copy become those of the table, also in a partition that is new or NULL."""
    t, keys, by = lake.name("silver", "t"), ("tenant_id", "k"), ("tenant_id", "mes")
    merge.upsert(rows(MONTHLY, ("a", "1", 1, "x"), ("b/ c", "1", 1, "y"), (None, "1", 1, "z")), t, keys, by)
    staged = []
    finish = merge.finish_interrupted

    def watch(session, table):
        path = merge._staging(session, table)
        if merge.path_exists(session, f"{path}/_SUCCESS"):
            copy = session.read.parquet(path)
            staged.extend(tuple(r) for r in copy.select("_metadata.file_name", "_metadata.file_size").distinct().collect())
        finish(session, table)

    monkeypatch.setattr(merge, "finish_interrupted", watch)
    merge.upsert(rows(MONTHLY, ("a", "1", 2, "new"), ("b/ c", "1", 1, "w"), (None, "1", 1, "n")), t, keys, by)
    found = {tuple(r) for r in spark.table(t).select("tenant_id", "k", "mes", "v").collect()}
    assert found == {("a", "1", 2, "new"), ("b/ c", "1", 1, "w"), (None, "1", 1, "n")}
    assert staged and files_of(spark, t) == set(staged)


def test_a_move_that_was_broken_off_is_finished(spark, lake, rows, monkeypatch):
    t, keys, by = lake.name("silver", "t"), ("tenant_id", "k"), ("tenant_id", "mes")
    merge.upsert(rows(MONTHLY, ("a", "1", 1, "x"), ("a", "2", 2, "y")), t, keys, by)

    def die(session, folder, table):
        """One folder is moved, then the driver is lost."""
        one = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/tenant_id=a/mes=1")
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{tables.describe(spark, table, 'Location')}/tenant_id=a/mes=1")
        fs = one.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(place, True)
        assert fs.rename(one, place)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "move_partitions", die)
        with pytest.raises(RuntimeError):
            merge.upsert(rows(MONTHLY, ("a", "1", 1, "p"), ("a", "2", 2, "q"), ("a", "3", 3, "r")), t, keys, by)
    merge.finish_interrupted(spark, t)
    assert {tuple(r) for r in spark.table(t).select("k", "mes", "v").collect()} == {("1", 1, "p"), ("2", 2, "q"), ("3", 3, "r")}


def test_unique_batches_are_neither_sorted_nor_copied_twice(spark, lake, rows, monkeypatch):
    t, copies = lake.name("silver", "t"), []
    real = merge.materialise
    monkeypatch.setattr(merge, "materialise", lambda df, label="stage": copies.append(label) or real(df, label))
    monkeypatch.setattr(merge, "dedup_latest", None)
    batch = real(rows(MONTHLY, ("a", "1", 1, "x")), "mine")
    merge.upsert(batch, t, ("tenant_id", "k"), order_by="v", unique=True, materialised=True)
    assert "batch" not in copies and spark.table(t).count() == 1


def test_merges_sort_by_a_hash_of_the_keys(spark, rows):
    a, b = rows(MONTHLY, ("a", "1", 1, "x")), rows(MONTHLY, ("a", "1", 2, "y"))
    plan = a.hint("merge").join(b, merge._same_keys(a, b, ["tenant_id", "k"]), "left_semi")._jdf.queryExecution().executedPlan().toString()
    sort = next(line for line in plan.splitlines() if " Sort [" in line)
    assert sort.split("Sort [", 1)[1].startswith("xxhash64(")


def test_months_of_the_feed_are_kept_without_a_shuffle(spark, lake, monkeypatch):
    """Entries and titles stay in their month folders; with a chart of accounts that is not small they are dealt anew."""
    names = [n for n in LEDGER if not n.startswith("dre")] + ["silver_dw_titulos_financeiros", "fct_titulo_financeiro"]
    arranged = {}
    real = tables.write_table

    def watch(df, name, partition_by=("tenant_id",), kept=False):
        arranged[name.split(".")[-1]] = kept
        return real(df, name, partition_by, kept)

    monkeypatch.setattr(tables, "write_table", watch)
    run = {"as_of": AS_OF, "calendar": CALENDAR}
    build_layers(spark, Feeds(spark, SMALL), lake, names, **run)
    assert {n for n, kept in arranged.items() if kept} == {"fct_lancamentos", "fct_titulo_financeiro"}
    for fact, source in (("fct_lancamentos", "silver_dw_lancamentos"), ("fct_titulo_financeiro", "silver_dw_titulos_financeiros")):
        made, fed = (len(spark.table(lake.name(layer, n)).inputFiles()) for layer, n in (("gold", fact), ("silver", source)))
        assert made <= fed
    before = {n: spark.table(lake.name("gold", n)).select(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0] for n in arranged if n.startswith("fct_")}
    monkeypatch.setattr("stratalake.plans.facts.SMALL_CHART", 0)
    build_layers(spark, Feeds(spark, SMALL), lake, ["fct_lancamentos"], **run)
    assert not arranged["fct_lancamentos"]
    after = spark.table(lake.name("gold", "fct_lancamentos")).select(F.sum(F.xxhash64("*").cast("decimal(38,0)"))).first()[0]
    assert after == before["fct_lancamentos"]


def test_tenants_are_written_side_by_side_without_a_sort(spark, lake, rows):
    lake.write(rows("tenant_id string, k string", ("a", "1"), ("b", "2"), ("a", "3")), "silver", "t")
    t = lake.name("silver", "t")
    plan = spark.sql(f"EXPLAIN INSERT INTO {t} SELECT concat(k, 'x'), tenant_id FROM {t}").first()[0]
    assert "Insert" in plan and "Sort" not in plan, plan


def test_small_partitions_are_joined_by_hashes(spark):
    """Both sides too large to broadcast, each partition measured to be small: no side is sorted."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
        kept = left.join(spark.range(900).select(F.col("id").cast("string").alias("b")), F.col("k") == F.col("b"), "left_anti")
        with joined_by_hashes(spark):
            assert len(kept.collect()) == 100
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert "ShuffledHashJoin" in final and "Sort [" not in final, plan


def test_settings_of_the_session_are_kept(spark):
    writers, threshold = "spark.sql.maxConcurrentOutputFileWriters", HASH_JOINS[0]
    before = spark.conf.get(writers)
    spark.conf.set(writers, "3")
    spark.conf.set(threshold, "1m")
    try:
        tables.Lake(spark)
        with joined_by_hashes(spark):
            assert spark.conf.get(threshold) == "1m"
        assert spark.conf.get(writers) == "3" and spark.conf.get(threshold) == "1m"
    finally:
        spark.conf.set(writers, before)
        spark.conf.unset(threshold)
    with joined_by_hashes(spark):
        assert spark.conf.get(threshold, None) == HASH_JOINS[1]
    assert spark.conf.get(threshold, None) is None


def test_more_partitions_than_writers_are_complete(spark, lake):
    """Beyond the writers of a task its rows are sorted: nothing is lost and nothing is doubled."""
    data = spark.range(0, 4000, 1, 2).select(F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(30))).alias("tenant_id"), F.col("id").cast("string").alias("k"))
    lake.write(data, "silver", "t")
    stored = lake.table("silver", "t").select("tenant_id", "k")
    assert stored.count() == 4000 and stored.exceptAll(data).isEmpty()


def test_merge_sorts_nothing_ahead_of_the_shuffle(spark, lake, rows, monkeypatch):
    """Either side has a key once, so a limit ahead of the shuffle would drop next to nothing."""
    ddl, keys, plans = "tenant_id string, k string, at int, v string", ("tenant_id", "k"), []
    t, arrange = lake.name("silver", "t"), merge.for_partitions

    def watch(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return arrange(df, *args)

    merge.upsert(rows(ddl, ("a", "1", 1, "x"), ("a", "2", 5, "y"), ("a", "3", None, "n"), ("b", "1", 2, "z")), t, keys, order_by="at")
    monkeypatch.setattr(merge, "for_partitions", watch)
    merge.upsert(rows(ddl, ("a", "1", 1, "same"), ("a", "2", 4, "old"), ("a", "3", 0, "new"), ("a", "4", None, "first")), t, keys, order_by="at")
    assert len(plans) == 1 and "Window" in plans[0] and "WindowGroupLimit" not in plans[0], plans
    assert {tuple(r) for r in spark.table(t).select("tenant_id", "k", "at", "v").collect()} == {
        ("a", "1", 1, "same"), ("a", "2", 5, "y"), ("a", "3", 0, "new"), ("a", "4", None, "first"), ("b", "1", 2, "z"),
    }
