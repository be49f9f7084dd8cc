"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What a large cluster needs from AQE: right-sized reducers, split hot join
# partitions and split hot write partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}

# For writes; a session that has not set them gets them with its first lake.
LARGE_TABLES = {
    # a task writes to a few partitions (tenants) side by side, and sorts its rows by partition only beyond that
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

RELEASE = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")

HASH_JOINS = ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "128m")


# Of the files of tables, staging copies and intermediate results: hashed keys are hexadecimal text, which only
# an entropy coder shortens.
CODEC = "zstd"

# Reducers before AQE merges them, for jobs of unknown size.
UNSIZED_PARTITIONS = 8192


def shuffle_partitions_for(input_bytes: int, per_partition: int = 256 << 20) -> int:
    """Reducers for the largest shuffle of a job: 200 at least, 50,000 at most.

    Beyond the upper bound the shuffle's bookkeeping (maps x reducers) costs more
    than larger, spilling partitions. AQE merges what turns out to be too small.
    """
    return max(200, min(50_000, -(-input_bytes // per_partition)))


def build_session(
    app: str = "stratalake",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots.

    Without ``input_bytes`` or a count of shuffle partitions AQE starts from many and
    merges them by measured size: it can join small reducers but not split those of an
    aggregate or window.
    """
    if input_bytes is not None:
        conf.setdefault("spark__sql__shuffle__partitions", str(shuffle_partitions_for(input_bytes)))
    elif "spark__sql__shuffle__partitions" not in conf:
        conf.setdefault("spark__sql__adaptive__coalescePartitions__initialPartitionNum", str(UNSIZED_PARTITIONS))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **LARGE_TABLES, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def for_large_tables(spark: SparkSession) -> None:
    """Set what the session has left open of ``LARGE_TABLES``; the results do not depend on it."""
    for key, value in LARGE_TABLES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


@contextmanager
def joined_by_hashes(spark: SparkSession) -> Iterator[None]:
    """Two large sides are joined by hashes, unsorted, where each partition of one side was measured to be small.

    For incremental runs, which read much to change little. Full builds sort: rows in the order of a key take
    less room. A threshold of the session's own is kept.
    """
    key, value = HASH_JOINS
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that made them ends, not when the driver happens to collect its garbage.

    For builds, whose jobs write what later ones read. A setting of the session's own is kept.
    """
    key, value = RELEASE
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session (tests) falls back to a fresh temporary folder; a cluster
    session without the setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="stratalake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/stratalake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Unlike a cache this survives lost executors, and unlike a checkpointed RDD
    the result keeps Parquet statistics for later join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
