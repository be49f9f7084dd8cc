"""Named tables of the Silver, Gold and Platinum layers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import CODEC, for_large_tables, scratch_path, shared_dir

# Database names are taken literally, never prefixed with a target.
LAYERS = {
    "bronze": "bronze_dev",
    "silver": "silver_dev",
    "gold": "gold_dev",
    "platinum": "platinum_dev",
}


DYNAMIC = ("partitionOverwriteMode", "dynamic")


class Lake:
    """Resolves (layer, name) to a catalog table below one storage root.

    ``prefix`` separates independent runs in one catalog (tests, back-fills).
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = "") -> None:
        self.spark = spark
        self.root = (root or f"{shared_dir(spark)}/stratalake/lake").rstrip("/")
        self.prefix = prefix
        self._ready: set[str] = set()
        for_large_tables(spark)

    def database(self, layer: str) -> str:
        name = self.prefix + LAYERS[layer]
        if name not in self._ready:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.root}/{name}.db'")
            self._ready.add(name)
        return name

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = ("tenant_id",),
        arranged: bool = False,
    ) -> DataFrame:
        return write_table(df, self.name(layer, table), partition_by, arranged)

    def view(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        return create_view(df, f"{self.prefix}{LAYERS[layer]}_{table}")


def for_partitions(df: DataFrame, partition_by: Sequence[str], arranged: bool = False) -> DataFrame:
    """Arrange rows for a partitioned write; those that are ``arranged`` stay where they are.

    By tenant alone nothing is moved: there are few tenants, each task writes at
    most one file per tenant, and the rows of a large tenant are already spread
    over the tasks. With finer partitions (dates) that would leave many small
    files, so the rows are rebalanced; AQE cuts a value that holds much of the
    data into advisory-size pieces written by different tasks.
    """
    if arranged or set(partition_by) <= {"tenant_id"}:
        return df
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = ("tenant_id",), arranged: bool = False
) -> DataFrame:
    """Full rebuild of a table. Rows that come by files of one partition each are ``arranged`` already.

    The rows are written to a new folder beside the old one, and the name is pointed
    at it when they are complete: a failed job leaves the old table as it was. Then
    the old folder goes. The table remembers that later partial overwrites replace
    partitions only, so merges need no session-wide setting and may run side by side.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    path = f"{base.rstrip('/')}/{table}-{uuid.uuid4().hex}"
    writer = for_partitions(df, partition_by, arranged).write.option("compression", CODEC)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)

    before = describe(spark, name, "Location") if spark.catalog.tableExists(name) else ""
    columns = [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    layout = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    options = {**dict([DYNAMIC] if partition_by else []), "compression": CODEC}
    option = f"OPTIONS ({', '.join(f"'{k}' = '{v}'" for k, v in options.items())})"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet {option} {layout} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    if before.startswith(base.rstrip("/")) and before != path:
        for folder in (before, keys_path(before)):
            old = spark._jvm.org.apache.hadoop.fs.Path(folder)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return spark.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, table: str, folder: str | None = None) -> None:
    """Replace exactly the partitions present in ``df``; the table must be partitioned.

    folder   holds exactly the rows of ``df`` in the layout of the table, and is given up: where it can be,
             its partition folders are moved into their places instead of being read and written again.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns)
    if f"{DYNAMIC[0]}={DYNAMIC[1]}" in describe(spark, table, "Storage Properties"):
        if folder is None or not move_partitions(spark, folder, table):
            rows.write.insertInto(table, overwrite=True)
        return
    # A table made elsewhere: it gets the option for good. A session-wide mode would
    # be shared with writes that run at the same time.
    spark.sql(f"ALTER TABLE {table} SET SERDEPROPERTIES ('{DYNAMIC[0]}' = '{DYNAMIC[1]}')")
    spark.catalog.refreshTable(table)
    rows.write.insertInto(table, overwrite=True)


def move_partitions(spark: SparkSession, folder: str, table: str) -> bool:
    """Put the partition folders below ``folder`` in the place of those of the table; False if they cannot be moved.

    For tables made by ``write_table``, whose partitions all lie below the table. A call that was broken off
    can be repeated: what has been moved is no longer below ``folder``, all else is moved then.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    source, place = hadoop.Path(folder), hadoop.Path(describe(spark, table, "Location"))
    fs, to = source.getFileSystem(conf), place.getFileSystem(conf)
    if not fs.getUri().equals(to.getUri()):
        return False
    staged = [(source, place)]
    for _ in partition_columns(spark, table):
        staged = [
            (s.getPath(), hadoop.Path(p, s.getPath().getName()))
            for parent, p in staged
            for s in fs.listStatus(parent)
            if s.isDirectory()
        ]

    def move(one: tuple) -> None:
        new, old = one
        fs.delete(old, True)
        fs.mkdirs(old.getParent())
        if not fs.rename(new, old):
            raise OSError(f"{new.toString()} was not moved to {old.toString()}")

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(move, staged))
    # partitions that are new to the table
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return True


def describe(spark: SparkSession, table: str, item: str) -> str:
    """One line of the table's extended description, empty if it is not there."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == item).first()
    return found["data_type"] if found else ""


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def restrict_to(target: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the listed partitions, pruned at directory level.

    The values of each partition column (tenants, months: metadata) prune the
    directories, however many there are; the semi join then keeps the listed
    combinations.
    """
    values = touched.agg(
        *[F.collect_set(c).alias(f"v{i}") for i, c in enumerate(by)],
        *[F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(by)],
    ).first()
    for i, c in enumerate(by):
        listed = target[c].isin(sorted(values[f"v{i}"])) if values[f"v{i}"] else F.lit(False)
        target = target.filter(listed | target[c].isNull() if values[f"n{i}"] else listed)
    same = reduce(and_, [target[c].eqNullSafe(touched[c]) for c in by])
    return target.join(touched, same, "left_semi")


def keys_path(location: str) -> str:
    """Folder of the key index of a table at ``location``; it goes with the table."""
    return f"{location.rstrip('/')}-keys"


def compact(spark: SparkSession, table: str, where: str, target_files: int) -> None:
    """Rewrite the partitions selected by ``where`` (partition columns only), each into at most ``target_files``.

    The rows are first copied to the shared folder, so the source files stay untouched
    until the copy is complete. Both writes deal partitions x ``target_files`` tasks; the
    second one too, because reading the copy may cut its files anew.
    """
    by = partition_columns(spark, table)
    source = spark.table(table).filter(where)
    path = scratch_path(spark, "compact")
    columns = [c for c in source.columns if c not in by]
    tasks = max(1, source.select(*by).distinct().count()) * target_files

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(tasks, *by, F.pmod(F.xxhash64(*columns), F.lit(target_files)))

    dealt(source).write.partitionBy(*by).parquet(path)
    overwrite_partitions(dealt(spark.read.schema(source.schema).parquet(path)), table)
