"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits skewed sort-merge partitions at run time and is the default for all
fact joins. These two helpers cover what AQE cannot see: a fan-out whose inputs
are small but whose output is large, and joins that run where AQE is off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(cols: Sequence[str], n: int) -> Column:
    """Deterministic bucket: a retried task gives the same rows the same bucket."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def fan_out(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    buckets: int = 64,
) -> DataFrame:
    """Many-to-many equi-join on a coarse key (all pairs within it are the wanted result).

    The inputs are small and the output is large, which defeats size-based
    planning: a shuffle on the few keys gives few tasks, and a broadcast join
    runs in as few tasks as the small ``left`` has. So ``left`` is spread by its
    full key over as many tasks as the session has shuffle partitions (an explicit
    count is not coalesced by AQE). ``right`` is never copied: each key has at most
    ``buckets`` rows of it, arrays of about a ``buckets``-th of its units, that the join
    meets and only then takes apart. Spark broadcasts them by their measured size;
    otherwise it shuffles, and AQE splits the tasks of a large key.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in right.columns if c not in on]
    packed = right.groupBy(*on, _bucket(columns, buckets).alias("_bucket")).agg(F.collect_list(F.struct(*columns)).alias("_units"))
    joined = left.repartition(tasks, *on, *spread_by).join(packed.drop("_bucket"), list(on))
    return joined.select(*left.columns, F.explode("_units").alias("_unit")).select(*left.columns, "_unit.*")


def heavy_hashes(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Hashes (``_hot``) of the keys that hold at least about ``share`` of all rows.

    One pass with a mergeable frequent-items sketch; at most 1/share rows. It
    only decides which keys are spread, never which rows are kept.
    """
    k = int(1 / share)
    hashed = df.select(F.xxhash64(*keys).alias("h"))
    return (
        hashed.agg(F.expr(f"approx_top_k(h, {k}, {max(10_000, 10 * k)})").alias("top"), F.count("*").alias("n"))
        .select(F.explode("top").alias("t"), "n")
        .filter(F.col("t.count") >= F.col("n") * share)
        .select(F.col("t.item").alias("_hot"))
    )


def join_spreading_hot_keys(
    fact: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
    buckets: int = 16,
) -> DataFrame:
    """Exact ``fact`` inner/left join ``other`` with only the hot keys salted.

    Rows of a hot key are spread over ``buckets`` by ``spread_by``; the matching
    rows of ``other`` are repeated per bucket. All other rows stay in bucket 0
    and are shuffled once. Hotness is decided by the key's hash on both sides, so
    a collision spreads one key more and changes nothing else. The hot list is
    broadcast: it has at most 1/share rows. NULL keys have a hash like any other.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    hot = F.broadcast(heavy_hashes(fact, on, share))
    is_hot = F.col("_hot").isNotNull()
    left = (
        fact.join(hot, F.xxhash64(*on) == F.col("_hot"), "left")
        .withColumn("_bucket", F.when(is_hot, _bucket(spread_by, buckets)).otherwise(0))
        .drop("_hot")
    )
    right = (
        other.join(hot, F.xxhash64(*on) == F.col("_hot"), "left")
        .withColumn("_last", F.when(is_hot, buckets - 1).otherwise(0))
        .withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.col("_last"))))
        .drop("_hot", "_last")
    )
    return left.join(right, [*on, "_bucket"], how).drop("_bucket")
