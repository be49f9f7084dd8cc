from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import as_set, plan_of
from stratalake.operators.skew import fan_out, heavy_hashes, join_spreading_hot_keys


@pytest.fixture
def hot(spark):
    """One key holds 40 % of the rows, one in ten keys is NULL."""
    key = F.when(F.col("id") % 10 < 4, F.lit("hot")).when(F.col("id") % 10 < 9, F.concat(F.lit("k"), F.col("id") % 97))
    fact = spark.range(4000).select(F.lit("u").alias("tenant_id"), key.alias("k"), F.col("id").alias("item"))
    dim = spark.range(97).select(F.lit("u").alias("tenant_id"), F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("d"))
    return fact, dim.unionByName(spark.sql("select 'u' tenant_id, 'hot' k, 1000L d"))


def test_heavy_keys_are_bounded(hot):
    fact, _ = hot
    expected = fact.filter("k = 'hot'").select(F.xxhash64("tenant_id", "k")).distinct()
    assert as_set(heavy_hashes(fact, ["tenant_id", "k"], share=0.2)) == as_set(expected)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spreading_keeps_the_result_whole(hot, how):
    fact, dim = hot
    plain = fact.join(dim, ["tenant_id", "k"], how)
    spread = join_spreading_hot_keys(fact, dim, ["tenant_id", "k"], ["item"], how=how, share=0.05, buckets=8)
    assert spread.count() == plain.count()
    assert spread.select(plain.columns).exceptAll(plain).count() == 0


def test_unsupported_join_type(hot):
    with pytest.raises(ValueError):
        join_spreading_hot_keys(*hot, ["k"], ["item"], how="full")


def test_fan_out_equals_the_join(spark):
    left = spark.range(50).select((F.col("id") % 2).alias("t"), "id")
    right = spark.range(14).select((F.col("id") % 2).alias("t"), F.col("id").alias("r"))
    got = fan_out(left, right, ["t"], ["id"], buckets=5)
    assert as_set(got.select("t", "id", "r")) == as_set(left.join(right, "t"))


def test_adaptive_execution_splits_a_hot_fact_key(spark, hot):
    fact, dim = hot
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = fact.repartition(8, "item").join(dim, ["tenant_id", "k"])
        assert len(joined.collect()) == 3600
        assert "isSkewJoin=true" in plan_of(joined) or "skew=true" in plan_of(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
