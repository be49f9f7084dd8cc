"""Bronze files: ``<root>/<datamart>/<table>/tenant_id=/year=/month=/day=/*.parquet``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.contract import (
    PARTITION_COLUMNS,
    REGISTRY,
    data_schema,
    full_schema,
)


def table_path(root: str, datamart: str, table: str) -> str:
    return f"{root.rstrip('/')}/{datamart}/{table}"


def read_bronze(spark: SparkSession, root: str, datamart: str, table: str) -> DataFrame:
    """Scan one feed with its declared types (no inference, no footer merge)."""
    return spark.read.schema(full_schema(datamart, table)).parquet(table_path(root, datamart, table))


def between_days(start: dt.date, end: dt.date) -> Column:
    """Predicate on the partition columns only, so that directories are pruned.

    Written as comparisons of plain partition columns: the leading ``year``
    bounds prune even where a metastore cannot evaluate the exact expression.
    """
    day = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    as_int = lambda d: d.year * 10000 + d.month * 100 + d.day
    return (
        F.col("year").between(start.year, end.year)
        & (day >= F.lit(as_int(start)))
        & (day <= F.lit(as_int(end)))
    )


def prune(
    df: DataFrame,
    tenants: Iterable[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    if tenants is not None:
        df = df.filter(F.col("tenant_id").isin(*tenants))
    if start is not None or end is not None:
        df = df.filter(between_days(start or dt.date(1, 1, 1), end or dt.date(9999, 12, 31)))
    return df


def delivered_since(df: DataFrame, day: dt.date) -> DataFrame:
    """Deliveries of ``day`` and later, by directory. A feed without partition columns is an error."""
    if not has_delivery_day(df):
        raise ValueError(f"no delivery day (year, month, day) among {df.columns}")
    return prune(df, start=day)


def has_delivery_day(df: DataFrame) -> bool:
    return {"year", "month", "day"} <= set(df.columns)


def with_partition_day(df: DataFrame, day: Column | str | dt.date) -> DataFrame:
    """Add year/month/day from the extraction date."""
    if isinstance(day, dt.date):
        day = F.lit(day)
    elif isinstance(day, str):
        day = F.col(day)
    return df.withColumns(
        {
            "year": F.year(day).cast("int"),
            "month": F.month(day).cast("int"),
            "day": F.dayofmonth(day).cast("int"),
        }
    )


def write_bronze(df: DataFrame, root: str, datamart: str, table: str) -> str:
    """Write a feed that carries the partition columns.

    Only the partitions present in ``df`` are replaced, so re-delivering a day
    is idempotent. The rebalance hint groups rows by partition for large files
    and lets AQE split a hot tenant over many writers.
    """
    columns = [*data_schema(datamart, table).fieldNames(), *PARTITION_COLUMNS]
    path = table_path(root, datamart, table)
    (
        df.select(*columns)
        .hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )
    return path


def register_bronze(spark: SparkSession, root: str, database: str = "bronze_dev") -> list[str]:
    """Expose every feed that has files as a temporary view ``<database>_<table>``.

    Views over explicit schemas need no catalog service; the partition columns
    stay prunable through the view.
    """
    names = []
    for datamart, table in REGISTRY:
        if not path_exists(spark, table_path(root, datamart, table)):
            continue
        name = f"{database}_{table}"
        read_bronze(spark, root, datamart, table).createOrReplaceTempView(name)
        names.append(name)
    return names


def register_external(spark: SparkSession, root: str, database: str = "bronze_dev") -> list[str]:
    """Catalog variant: external partitioned tables, partitions recovered from the layout."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for datamart, table in REGISTRY:
        path = table_path(root, datamart, table)
        if not path_exists(spark, path):
            continue
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in full_schema(datamart, table))
        name = f"{database}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(
            f"CREATE TABLE {name} ({ddl}) USING parquet "
            f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name}")
        names.append(name)
    return names


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def unify_tenants(feeds: dict[str, DataFrame]) -> DataFrame:
    """One table from per-tenant extracts, keeping ``tenant_id``.

    Columns are matched by name; a column a tenant does not deliver is NULL.
    """
    tagged = [df.withColumn("tenant_id", F.lit(tenant)) for tenant, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
