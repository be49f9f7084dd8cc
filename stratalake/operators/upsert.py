"""Upsert (merge by key) into partitioned Parquet tables.

``MERGE INTO`` needs a table format that is not always installed, so the merge
is a join plus a replacement of the touched partitions:

1. find the partitions the batch can change,
2. write their merged content to a staging folder in shared storage,
3. replace these partitions from the staging folder.

Step 3 takes only the completed copy, whose folders are moved where table and copy share a file system. If the driver dies in the middle, the
next call finds the copy and repeats the replacement, which is idempotent.
Partitions that are not touched are neither read (beyond key columns) nor written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stratalake.operators import key_index
from stratalake.operators.dedup import dedup_latest, latest_of_few
from stratalake.session import CODEC, materialise, shared_dir
from stratalake.sources.bronze import path_exists
from stratalake.sources.tables import (
    describe,
    for_partitions,
    overwrite_partitions,
    partition_columns,
    restrict_to,
    write_table,
)


class DuplicateKeys(ValueError):
    """A batch holds several rows for one key and no order to choose by."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def upsert(
    batch: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("tenant_id",),
    order_by: str | Sequence[str] | None = None,
    on_schema_change: str = "append_new_columns",
    stable_partitions: bool = False,
    replaces: DataFrame | None = None,
    indexed: bool = False,
    unique: bool = False,
    materialised: bool = False,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys and replace existing ones; returns the table.

    order_by           keep the greater of stored and incoming row (late data never
                       overwrites newer data). Without it the incoming row wins and
                       duplicate keys inside the batch are an error.
    on_schema_change   "append_new_columns", "ignore" or "fail".
    stable_partitions  promise that a key never changes its partition values; saves
                       the key scan that looks for old versions in other partitions.
                       Given anyway where the partition columns are part of the key.
    replaces           stored rows that agree with one of its rows in all its columns go,
                       whether or not the batch has their key (groups computed anew). If it has the
                       partition columns, the stored rows are not searched for the partitions.
    indexed            keep an index of the keys beside the table (``key_index``); old versions are
                       then looked for in the partitions that may hold a key of the batch.
    unique             promise that no key is repeated in the batch, which is then not looked for.
    materialised       the batch is read from a copy already and is not copied again.
    derived            expressions of columns that follow from others of the row, in stored rows as well, like hashed
                       keys: they are neither copied nor shuffled, but made again for the write.
    """
    spark = batch.sparkSession
    derived = derived or {}
    if not unique:
        batch = _unique_batch(batch, keys, order_by)
    if not materialised:
        batch = materialise_without(batch, derived, "batch")
    if order_by is None and not unique and _repeats(batch, keys):
        raise DuplicateKeys(f"duplicate {tuple(keys)} in the batch for {table}")
    if not spark.catalog.tableExists(table):
        return write_table(batch, table, partition_by)

    finish_interrupted(spark, table)
    batch = _align(spark, table, batch, on_schema_change)
    target = spark.table(table)
    derived = {c: made for c, made in derived.items() if c in target.columns}
    by = partition_columns(spark, table)
    stable = stable_partitions or set(by) <= set(keys)
    touched = batch.select(*by).distinct()
    if not stable:
        # by hashes alone: a key that only shares one adds a partition, which is then written as it was
        old = _may_hold(batch, table, keys, indexed).select(F.xxhash64(*keys).alias("_key"), *by)
        incoming = batch.select(F.xxhash64(*keys).alias("_key"))
        touched = touched.union(old.join(incoming, "_key", "left_semi").select(*by)).distinct()
    if replaces is not None:
        gone = replaces
        if not set(by) <= set(replaces.columns):
            gone = target.join(replaces, _same_keys(target, replaces, replaces.columns), "left_semi")
        touched = touched.union(gone.select(*by)).distinct()
    touched = materialise(touched, "touched")
    if touched.isEmpty():
        return target
    current = restrict_to(target, touched, by)
    if replaces is not None:
        current = current.join(replaces, _same_keys(current, replaces, replaces.columns), "left_anti")
    current, batch = current.drop(*derived), batch.drop(*derived)

    if order_by is None:
        merged = current.join(
            batch.select(*keys), _same_keys(current, batch, keys), "left_anti"
        ).unionByName(batch)
    else:
        order = [order_by] if isinstance(order_by, str) else list(order_by)
        both = current.withColumn("_incoming", F.lit(0)).unionByName(
            batch.withColumn("_incoming", F.lit(1))
        )
        # either side has a key once
        merged = latest_of_few(both, keys, [*order, "_incoming"]).drop("_incoming")

    path = _staging(spark, table)
    whole = for_partitions(merged, by).withColumns(derived).select(*target.columns)
    whole.write.mode("overwrite").option("compression", CODEC).partitionBy(*by).parquet(path)
    emptied = [] if stable and replaces is None else _emptied(spark, path, target, touched, by)
    finish_interrupted(spark, table)
    if emptied:
        specs = [", ".join(f"{c} = {_literal(row[c])}" for c in by) for row in emptied]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({s})' for s in specs)}")
    if indexed and not stable:
        key_index.refresh(spark, table, keys)
    return spark.table(table)


def materialise_without(df: DataFrame, derived: Mapping[str, Column], label: str) -> DataFrame:
    """A copy of ``df`` whose ``derived`` columns are made again when it is read."""
    made = {c: e for c, e in derived.items() if c in df.columns}
    return materialise(df.drop(*made), label).withColumns(made).select(*df.columns)


def changed_versions(batch: DataFrame, table: str, keys: Sequence[str], indexed: bool = False) -> DataFrame:
    """Stored rows that ``batch`` is about to replace, with ``_sign`` -1, and the rows of the batch with 1.

    For batches whose rows always win. Sums over the signed rows correct stored sums by what the merge changes.
    """
    target = _may_hold(batch, table, keys, indexed)
    old = target.join(batch.select(*keys), _same_keys(target, batch, keys), "left_semi")
    new = batch.select(*old.columns)
    return old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))


def _may_hold(batch: DataFrame, table: str, keys: Sequence[str], indexed: bool) -> DataFrame:
    """The stored table without partitions that surely hold no key of ``batch``."""
    target = batch.sparkSession.table(table)
    places = key_index.candidates(batch, table, keys) if indexed else None
    if places is None:
        return target
    return restrict_to(target, materialise(places, "candidates"), partition_columns(batch.sparkSession, table))


def _unique_batch(
    batch: DataFrame, keys: Sequence[str], order_by: str | Sequence[str] | None
) -> DataFrame:
    return batch if order_by is None else dedup_latest(batch, keys, order_by)


def _repeats(batch: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key is repeated. Few batches have a repeated hash; only then the keys themselves are grouped."""
    hashes = batch.select(F.xxhash64(*keys).alias("_key"))
    return not duplicate_keys(hashes, ["_key"]).isEmpty() and not duplicate_keys(batch, keys).isEmpty()


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """NULL-safe equality, so re-delivering a row with a NULL key part does not duplicate it.

    Led by a hash of the keys: a sort is then settled by eight bytes instead of texts with common prefixes.
    """
    same = [left[k].eqNullSafe(right[k]) for k in keys]
    if all(left.schema[k].dataType == right.schema[k].dataType for k in keys):
        same.insert(0, F.xxhash64(*[left[k] for k in keys]) == F.xxhash64(*[right[k] for k in keys]))
    return reduce(and_, same)


def _align(spark: SparkSession, table: str, batch: DataFrame, on_schema_change: str) -> DataFrame:
    """Bring batch and table to the same columns."""
    have = {f.name: f.dataType for f in spark.table(table).schema}
    new = [f for f in batch.schema if f.name not in have]
    if new and on_schema_change == "fail":
        raise ValueError(f"new columns for {table}: {[f.name for f in new]}")
    if new and on_schema_change == "append_new_columns":
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
        have.update({f.name: f.dataType for f in new})
    return batch.select(
        *[
            (F.col(n) if n in batch.columns else F.lit(None)).cast(t).alias(n)
            for n, t in have.items()
        ]
    )


def _staging(spark: SparkSession, table: str) -> str:
    """One fixed folder per table location, so that a later session finds an unfinished copy."""
    location = describe(spark, table, "Location")
    return f"{shared_dir(spark)}/stratalake/upsert/{hashlib.md5(location.encode()).hexdigest()}"


def finish_interrupted(spark: SparkSession, table: str) -> None:
    """Apply a completed staging copy, if one is there, and remove it."""
    path = _staging(spark, table)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return
    target = spark.table(table)
    staged = spark.read.schema(target.schema).parquet(path)
    # The staged files already hold one partition each: move them, or copy them without a shuffle.
    overwrite_partitions(staged, table, path)
    spark.catalog.refreshTable(table)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _emptied(
    spark: SparkSession, path: str, target: DataFrame, touched: DataFrame, by: Sequence[str]
) -> list[Row]:
    """Touched partitions without a remaining row (their last key moved elsewhere).

    The partition overwrite does not see them. Should the driver die before they
    are dropped, repeating the batch finds them again.
    """
    kept = spark.read.schema(target.schema).parquet(path).select(*by).distinct()
    same = reduce(and_, [touched[c].eqNullSafe(kept[c]) for c in by])
    return touched.join(kept, same, "left_anti").collect()


def _literal(value: object) -> str:
    return "null" if value is None else "'" + str(value).replace("'", "\\'") + "'"
