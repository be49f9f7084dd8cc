"""Which partitions of a stored table may hold a key.

For each partition an index beside the table keeps the range of a key column and a Bloom filter, as rows: the
filter is cut into words of 64 bits, a key sets a few bits of one word. A batch is joined with the words its
keys fall on, so only partitions that may hold one of them are opened, and there the keys are compared.

An entry counts only while the partition has the very files it was made from. Whatever else wrote to the
table, or a driver lost between table and index, makes a partition unknown, and unknown ones are opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import materialise
from stratalake.sources.bronze import path_exists
from stratalake.sources.tables import describe, keys_path, partition_columns, restrict_to

BITS = 5  # of a word, for each key
KEYS_PER_WORD = 3  # about 0.2 % of foreign keys pass


def _path(spark: SparkSession, table: str, part: str) -> str:
    return f"{keys_path(describe(spark, table, 'Location'))}/{part}"


def partition_files(spark: SparkSession, table: str) -> DataFrame:
    """(partition columns, state) from a listing: no file is opened. The state changes with any file."""
    location = describe(spark, table, "Location")
    types = {f.name: f.dataType for f in spark.table(table).schema}
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(location)

    def value(c: str) -> Column:
        text = F.regexp_extract("path", f"/{c}=([^/]*)/", 1)
        plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", plain).cast(types[c]).alias(c)

    by = partition_columns(spark, table)
    # without content a file costs nothing, but Spark plans a task for each small one
    files = files.select("path", "length").coalesce(spark.sparkContext.defaultParallelism)
    named = files.select(*[value(c) for c in by], F.xxhash64(F.substring_index("path", "/", -1), "length").alias("file"))
    # a sum of hashes without overflow: the order of files does not count
    return named.groupBy(*by).agg(F.sum(F.pmod("file", F.lit(1 << 40))).alias("state"), F.count("*").alias("files"))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys, F.lit("key index"))


def _mask(h: Column) -> Column:
    """Bits of a word, from parts of the hash that do not choose the word."""
    places = [F.shiftrightunsigned(h, 64 - 6 * (i + 1)).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), x) for x in places]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _word(h: Column, n_words: Column) -> Column:
    return h.bitwiseAND(n_words - 1)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def _range_column(keys: Sequence[str], by: Sequence[str]) -> str:
    return next((k for k in reversed(keys) if k not in by), keys[-1])


def valid(spark: SparkSession, table: str, files: DataFrame) -> DataFrame | None:
    """Index entries (partition columns, lo, hi, keys, n_words) that still describe their partition; None without an index."""
    path = _path(spark, table, "ranges")
    if not path_exists(spark, path):
        return None
    by = partition_columns(spark, table)
    # appended with each merge; of a partition the entry of its present files counts
    entries = spark.read.parquet(path)
    same = _same(entries, files, by) & (entries["state"] == files["state"]) & (entries["files"] == files["files"])
    return entries.join(files, same, "left_semi").dropDuplicates([*by])


def candidates(batch: DataFrame, table: str, keys: Sequence[str]) -> DataFrame | None:
    """Partitions (distinct values of the partition columns) that may hold a key of ``batch``; None without an index."""
    spark = batch.sparkSession
    if not path_exists(spark, _path(spark, table, "ranges")):
        return None
    by = partition_columns(spark, table)
    files = materialise(partition_files(spark, table), "key-files")
    entries = materialise(valid(spark, table, files), "key-entries")
    unknown = files.join(entries, _same(files, entries, by), "left_anti").select(*by)
    known = [c for c in by if c in keys]
    ranged = _range_column(keys, by)
    # one for each time the index was sized: it doubles
    sizes = sorted(r[0] for r in entries.select("n_words").distinct().collect())
    each = F.explode(F.array(*[F.lit(n) for n in sizes]).cast("array<bigint>")).alias("n_words")
    wanted = batch.select(*known, F.col(ranged).alias("_k"), _hash(keys).alias("_h"), each)
    wanted = wanted.withColumn("word", _word(F.col("_h"), F.col("n_words"))).withColumn("mask", _mask(F.col("_h")))
    words = spark.read.parquet(_path(spark, table, "words"))
    words = words.join(entries, [*_on(words, entries, by), words["state"] == entries["state"]], "inner").select(
        *[words[c] for c in by], words["word"], words["bits"], entries["lo"], entries["hi"], entries["n_words"]
    )
    hit = (
        _same(wanted, words, known) if known else F.lit(True)
    ) & (wanted["word"] == words["word"]) & (wanted["n_words"] == words["n_words"])
    inside = wanted["_k"].isNull() | wanted["_k"].between(words["lo"], words["hi"])
    found = wanted.join(words, hit & inside & (words["bits"].bitwiseAND(wanted["mask"]) == wanted["mask"]))
    return found.select(*[words[c] for c in by]).union(unknown).distinct()


def _on(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [left[c].eqNullSafe(right[c]) for c in columns]


def refresh(spark: SparkSession, table: str, keys: Sequence[str]) -> None:
    """Index the partitions that have no valid entry; reads their key columns only."""
    by = partition_columns(spark, table)
    files = materialise(partition_files(spark, table), "key-files")
    entries = valid(spark, table, files)
    missing = files
    if entries is not None:
        missing = files.join(entries, _same(files, entries, by), "left_anti")
    missing = materialise(missing, "key-missing")
    if missing.isEmpty():
        return
    ranged = _range_column(keys, by)
    rows = restrict_to(spark.table(table), missing.select(*by), by).select(*by, F.col(ranged).alias("_k"), _hash(keys).alias("_h"))
    made = rows.groupBy(*by).agg(F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.count("*").alias("keys"))
    made = materialise(made.join(missing, _same(made, missing, by)).select(*[made[c] for c in by], "lo", "hi", "keys", "state", "files"), "key-ranges")
    largest = made.agg(F.max("keys")).first()[0] or 0
    used = entries.agg(F.max("n_words")).first()[0] if entries is not None else None
    needed = 1 << max(0, (largest // KEYS_PER_WORD).bit_length())
    n_words = used if used and used >= needed // 2 else 2 * needed
    words = (
        rows.withColumn("word", _word(F.col("_h"), F.lit(n_words).cast("bigint")))
        .groupBy(*by, "word")
        .agg(F.bit_or(_mask(F.col("_h"))).alias("bits"))
    )
    words = words.join(made, _same(words, made, by)).select(*[words[c] for c in by], "word", "bits", "state")
    # words first: without its range entry a partition is unknown
    words.write.mode("append").parquet(_path(spark, table, "words"))
    made.withColumn("n_words", F.lit(n_words).cast("bigint")).write.mode("append").parquet(_path(spark, table, "ranges"))
