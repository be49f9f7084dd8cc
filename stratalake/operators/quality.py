"""Data-quality checks. Each returns the failing rows; no rows means the check passes.

Checks that look for repeated or unknown values aggregate before any shuffle
(partial counts per map task), so one value held by a third of the rows is one
partial row per task. ``n_records`` is the number of failing source rows.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.temporal import now_ts
from stratalake.session import materialise
from stratalake.sources.bronze import path_exists, prune, read_bronze, table_path
from stratalake.sources.conform import schema_differences
from stratalake.sources.contract import PARTITION_COLUMNS, REGISTRY, data_schema
from stratalake.sources.footers import footers


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All not-null checks of a table in one scan: (column_name, n_records) of failing columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_records")) for c in columns]
    )
    return counts.select(F.inline(rows)).filter("n_records > 0")


def unique(df: DataFrame, column: str, stored: bool = False) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column], stored)


# Numbers of hash buckets that may hold a repeated key; that many integers are broadcast at most.
BUCKETS = 1 << 20


def unique_combination(
    df: DataFrame, columns: Sequence[str], stored: bool = False, buckets: int = BUCKETS
) -> DataFrame:
    """Combinations that occur more than once; NULLs compare equal.

    stored   the rows lie in a table and may be read twice: first 48 bits of a hash of each combination are
             grouped, which shuffle less than texts and hashed keys do. Only rows in the bucket of a repeated
             hash are then grouped by what they hold; without such a hash nothing is read again.
    """
    if stored:
        short = F.shiftrightunsigned(F.xxhash64(*columns), 16)
        bucket = F.pmod(short, F.lit(buckets))
        hashes = df.select(short.alias("__hash")).groupBy("__hash").agg(F.count("*").alias("__n"))
        repeated = hashes.filter("__n > 1").select(F.pmod("__hash", F.lit(buckets)).alias("__bucket")).distinct()
        df = df.join(F.broadcast(repeated), bucket == repeated["__bucket"], "left_semi")
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Non-NULL values outside the list."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return bad.groupBy(column).agg(F.count("*").alias("n_records"))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-NULL child values without a parent row. Compares the single column only.

    The child is reduced to (value, count) first: the anti join sees each value once.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
    )
    known = parent.select(F.col(parent_column).alias("_known"))
    return values.join(known, F.col(column) == F.col("_known"), "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child rows behind :func:`relationships`."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.filter(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_known"), "left_anti"
    )


def total_mismatch(
    df: DataFrame, keys: Sequence[str], total: str, quantity: str, unit: str, tolerance: str = "0.01"
) -> DataFrame:
    """Rows whose total differs from quantity times unit price by more than the tolerance."""
    gap = F.abs(F.col(total) - F.col(quantity) * F.col(unit)).cast("decimal(38,6)")
    return df.select(*keys, quantity, unit, total, gap.alias("divergencia")).filter(
        F.col("divergencia") > F.lit(tolerance).cast("decimal(10,6)")
    )


def tenant_leak(df: DataFrame, tenant: str) -> DataFrame:
    """Rows of other tenants inside a tenant slice, counted per tenant."""
    return (
        df.filter(F.col("tenant_id") != tenant)
        .groupBy("tenant_id")
        .agg(F.count("*").alias("qt_registros_invalidos"))
    )


def negative_values(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return df.select(*keys, column).filter(F.col(column) < 0)


def outside_range(
    df: DataFrame, column: str, low: object = None, high: object = None
) -> DataFrame:
    """Non-NULL values below ``low`` or above ``high`` (bounds included in the valid range)."""
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < F.lit(low))
    if high is not None:
        bad = bad | (c > F.lit(high))
    return df.filter(c.isNotNull() & bad)


def volume_outside(
    df: DataFrame, groups: Sequence[str], expected: int | Column, tolerance: float = 0.20
) -> DataFrame:
    """Groups whose row count leaves expected +/- tolerance; no groups = the whole table."""
    expected = F.lit(expected) if isinstance(expected, int) else expected
    counts = df.groupBy(*groups).agg(F.count("*").alias("n_records"))
    low, high = 1 - tolerance, 1 + tolerance
    return counts.filter(
        (F.col("n_records") < expected * low) | (F.col("n_records") > expected * high)
    )


def row_count_outside(df: DataFrame, low: int, high: int) -> DataFrame:
    counts = df.agg(F.count("*").alias("n_records"))
    return counts.filter(~F.col("n_records").between(low, high))


def column_set_mismatch(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """Names that are only in the table or only in the expected set."""
    return sorted(set(df.columns) ^ set(expected))


def column_differences(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(column_name, difference) of the columns that are missing or not expected."""
    rows = [(c, "missing") for c in expected if c not in df.columns]
    rows += [(c, "unexpected") for c in df.columns if c not in expected]
    return df.sparkSession.createDataFrame(sorted(rows), "column_name string, difference string")


def unbalanced_entries(
    entries: DataFrame,
    period: str,
    value: str = "vlr_lancamento",
    side: str = "cd_tipo_lancamento",
) -> DataFrame:
    """(tenant, period) groups whose debits and credits differ."""
    amount = lambda kind: F.coalesce(
        F.sum(F.when(F.col(side) == kind, F.col(value))), F.lit(0)
    ).cast("decimal(18,2)")
    sums = entries.groupBy("tenant_id", period).agg(
        amount("DEBITO").alias("vlr_debito"), amount("CREDITO").alias("vlr_credito")
    )
    return sums.filter("vlr_debito <> vlr_credito")


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, tolerance: str = "0.001"
) -> DataFrame:
    """Key totals of two builds that differ by more than a relative tolerance.

    Both sides are summed first; the full outer join sees one row per key.
    A key on one side only is a difference.
    """
    total = F.sum(value).cast("decimal(18,2)")
    a = left.groupBy(*keys).agg(total.alias("vlr_esquerda"))
    b = right.groupBy(*keys).agg(total.alias("vlr_direita"))
    both = a.join(b, reduce(and_, [a[k].eqNullSafe(b[k]) for k in keys]), "full").select(
        *[F.coalesce(a[k], b[k]).alias(k) for k in keys], "vlr_esquerda", "vlr_direita"
    )
    gap = F.abs(F.col("vlr_esquerda") - F.col("vlr_direita"))
    limit = F.abs(F.col("vlr_esquerda")) * F.lit(tolerance).cast("decimal(10,6)")
    one_sided = F.col("vlr_esquerda").isNull() | F.col("vlr_direita").isNull()
    return both.filter(one_sided | (gap > limit))


def _checksums(df: DataFrame, side: str, buckets: int) -> DataFrame:
    """Count and sums of two row hashes by bucket of the first one; the sums do not depend on the order of rows."""
    # a null leaves a hash as it is, so what is null is hashed too
    cells = [c for name in df.columns for c in (F.col(name), F.col(name).isNull())]
    hashed = df.select(F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(1), *cells).alias("g"))
    low = F.lit(0xFFFFFFFF)
    # halves of 32 bits, whose sums fit into 64 bits
    parts = [part for h in ("h", "g") for part in (F.col(h).bitwiseAND(low), F.shiftright(h, 32))]
    halves = [F.sum(part).alias(f"{side}{n}") for n, part in enumerate(parts)]
    return hashed.groupBy(F.pmod("h", F.lit(buckets)).alias("__bucket")).agg(F.count("*").alias(f"{side}_n"), *halves)


def differing_rows(left: DataFrame, right: DataFrame, buckets: int = 65_536) -> DataFrame:
    """Rows that two builds of a table do not hold equally often, with ``n_left`` and ``n_right``.

    Both sides are first reduced to checksums of hash buckets, which hardly shuffles anything. Only rows of buckets
    whose checksums differ (at most ``buckets`` numbers, broadcast) are grouped by their whole content. NULLs compare
    equal, repeated rows count as often as they occur, an empty side makes every row of the other one a difference.
    Names and types of the columns must be the same on both sides; their order is the left one's.
    """
    types = lambda df: {f.name: f.dataType for f in df.schema}
    if types(left) != types(right):
        raise ValueError(f"columns differ: {left.schema.simpleString()}, {right.schema.simpleString()}")
    columns = left.columns
    right = right.select(*columns)
    a, b = _checksums(left, "a", buckets), _checksums(right, "b", buckets)
    same = reduce(and_, [F.col(f"a{n}").eqNullSafe(F.col(f"b{n}")) for n in ("_n", 0, 1, 2, 3)])
    changed = materialise(a.join(b, "__bucket", "full").filter(~same).select("__bucket"), "checksums")
    row_bucket = F.pmod(F.xxhash64(*[c for name in columns for c in (F.col(name), F.col(name).isNull())]), F.lit(buckets))

    def suspects(df: DataFrame, on_left: int) -> DataFrame:
        found = df.join(F.broadcast(changed), row_bucket == changed["__bucket"], "left_semi")
        return found.select("*", F.lit(on_left).alias("__left"))

    both = suspects(left, 1).unionByName(suspects(right, 0))
    n_left, n_right = F.sum("__left"), F.sum(1 - F.col("__left"))
    return both.groupBy(*columns).agg(n_left.alias("n_left"), n_right.alias("n_right")).filter("n_left <> n_right")


class EmptyPartition(RuntimeError):
    """The ingestion gate found no rows."""


def partition_rows(df: DataFrame, tenant: str, day: dt.date) -> DataFrame:
    """Row count of one Bronze partition; prunes to a single directory."""
    return df.filter(
        (F.col("tenant_id") == tenant)
        & (F.col("year") == day.year)
        & (F.col("month") == day.month)
        & (F.col("day") == day.day)
    ).agg(F.count("*").alias("n"))


def require_partition(df: DataFrame, tenant: str, day: dt.date) -> int:
    n = partition_rows(df, tenant, day).first()["n"]
    if n == 0:
        raise EmptyPartition(f"{tenant} {day.isoformat()}")
    return n


def expected_partitions(
    spark: SparkSession, tenants: Sequence[str], start: dt.date, end: dt.date
) -> DataFrame:
    """One row per (tenant, day) that must have been delivered."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("d")
    names = F.explode(F.array(*[F.lit(t) for t in tenants])).alias("tenant_id")
    return spark.range(1).select(days).select(
        names, F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day")
    )


def missing_partitions(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (tenant, year, month, day) without a single row.

    The partition columns come from directory names; no data column is read.
    """
    keys = ["tenant_id", "year", "month", "day"]
    return expected.join(actual.select(*keys).distinct(), keys, "left_anti")


def delivery_report(df: DataFrame) -> DataFrame:
    """Files and rows per (tenant, day)."""
    return df.groupBy("tenant_id", "year", "month", "day").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("n_records")
    )


def delivered_footers(
    spark: SparkSession,
    root: str,
    datamart: str,
    table: str,
    tenants: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """(tenant_id, year, month, day, path, n_records, data_schema, error) of every delivered file, from its footer."""
    types = {"tenant_id": "string", "year": "int", "month": "int", "day": "int"}
    return footers(spark, table_path(root, datamart, table), types, lambda files: prune(files, tenants, start, end))


def footer_report(files: DataFrame) -> DataFrame:
    """Files and rows per (tenant, day), without reading a row; a file without a footer has none."""
    return files.groupBy("tenant_id", "year", "month", "day").agg(
        F.count("*").alias("files"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records")
    )


def contract_differences(
    spark: SparkSession,
    root: str,
    datamart: str,
    table: str,
    tenants: Sequence[str] | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """(tenant_id, year, month, day, path, difference) of every delivered file that differs from the contract.

    The footers are read in tasks, those of files without rows as well; a file without one is a difference.
    Few schemas are distinct, and each is compared with the contract once per task.
    """
    want = data_schema(datamart, table)
    ddl = "tenant_id string, year int, month int, day int, path string, difference string"

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            at, found = [], []
            for r, (schema, error) in enumerate(zip(batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True)):
                if error is None and schema not in known:
                    have = T.StructType.fromJson(json.loads(schema))
                    known[schema] = schema_differences(T.StructType([f for f in have if f.name not in PARTITION_COLUMNS]), want)
                for d in [f"unreadable: {error}"] if error else known[schema]:
                    at.append(r)
                    found.append(d)
            kept = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in range(5)), pa.array(found, pa.string())], [*batch.schema.names[:5], "difference"])

    files = delivered_footers(spark, root, datamart, table, tenants, start, end)
    return files.select("tenant_id", "year", "month", "day", "path", "data_schema", "error").mapInArrow(compare, ddl)


def audit_deliveries(
    spark: SparkSession, root: str, tenants: Sequence[str], start: dt.date, end: dt.date
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Check all feeds below ``root`` for a range of days.

    Returns the missing (datamart, table, tenant, day) and, per feed, how any of
    the files of these tenants and days differ from the contract; which files do
    is in ``contract_differences``.
    """
    expected = expected_partitions(spark, tenants, start, end)
    gaps, differences = [], {}
    for datamart, table in REGISTRY:
        path = table_path(root, datamart, table)
        missing = expected
        if path_exists(spark, path):
            feed = prune(read_bronze(spark, root, datamart, table), tenants, start, end)
            missing = missing_partitions(feed, expected)
            found = contract_differences(spark, root, datamart, table, tenants, start, end)
            # distinct differences, not files: missing columns, unexpected ones, other types
            some = [r[0] for r in found.select("difference").distinct().collect()]
            kind = {"missing": 0, "unexpected": 1}
            differences[f"{datamart}.{table}"] = sorted(some, key=lambda d: (kind.get(d.split(" ")[0], 2), d))
        gaps.append(missing.select(F.lit(datamart).alias("datamart"), F.lit(table).alias("table"), "*"))
    return reduce(DataFrame.unionByName, gaps), {k: v for k, v in differences.items() if v}


def contract_violations(df: DataFrame, expected: T.StructType) -> list[str]:
    return schema_differences(df.schema, expected)


def freshness(
    df: DataFrame, now: dt.datetime | str | None = None, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest Bronze partition, by its partition date."""
    newest = df.agg(F.max(F.make_date("year", "month", "day")).alias("newest"))
    age = now_ts(now) - F.col("newest").cast("timestamp_ntz")
    hours = (F.extract(F.lit("DAY"), age) * 24 + F.extract(F.lit("HOUR"), age)).cast("bigint")
    state = (
        F.when(F.col("newest").isNull() | (hours >= error_hours), "error")
        .when(hours >= warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.select("newest", hours.alias("age_hours"), state.alias("status"))


def summarise(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, failures) of several checks as one lazily evaluated result."""
    parts = [
        df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)
