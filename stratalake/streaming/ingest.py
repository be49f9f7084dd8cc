"""New Bronze files trigger an incremental upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.upsert import upsert


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files as they arrive; partition directories become columns."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def upsert_stream(
    feed: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = ("tenant_id",),
    available_now: bool = True,
) -> StreamingQuery:
    """Merge every micro-batch into ``table`` by key, keeping the greatest ``order_by``.

    Late data is always accepted: the order column decides, not the arrival
    order, so files may come in any sequence and a replayed batch changes
    nothing. The checkpoint must be in shared storage.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        upsert(rows, table, keys, partition_by, order_by=order_by)

    writer = feed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
