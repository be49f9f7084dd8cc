from __future__ import annotations

import random

from conftest import as_set
from stratalake.session import scratch_path
from stratalake.streaming.ingest import stream_feed, upsert_stream

DDL = "tenant_id string, k string, at int, v string"
KEYS = ("tenant_id", "k")


def run(spark, landing, table, checkpoint):
    feed = stream_feed(spark, landing, spark.table("stream_schema").schema, max_files=1)
    upsert_stream(feed, table, KEYS, "at", checkpoint).awaitTermination()


def test_late_files_and_restarts_equal_one_build(spark, lake, rows):
    random.seed(3)
    rows(DDL, ("a", "1", 1, "x")).limit(0).createOrReplaceTempView("stream_schema")
    data = [(random.choice("ab"), str(random.randrange(5)), n, random.choice("xyz")) for n in range(30)]
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    table = lake.name("silver", "s")
    newest_first = [data[20:], data[10:20]]
    for part in newest_first:
        rows(DDL, *part).coalesce(1).write.mode("append").parquet(landing)
    run(spark, landing, table, checkpoint)
    rows(DDL, *data[:10]).coalesce(1).write.mode("append").parquet(landing)  # late data
    run(spark, landing, table, checkpoint)  # resumes from the checkpoint
    best: dict = {}
    for row in data:
        best[row[:2]] = row  # the order column grows with the position
    assert as_set(spark.table(table).select("tenant_id", "k", "at", "v")) == set(best.values())
