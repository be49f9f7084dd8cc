"""How text filters act on one another in every order, with the duplicate filter among them.

Most texts are unique, and their texts need not be shuffled to know it: counting Bloom sketches of all
texts, built within tasks and merged by shards of the hash space, clear every text whose counters show
it alone. Only the others, and the few that collide, are grouped by their whole text. A document is then
five bits, and every figure of every order is a sum over the counts of the 32 masks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import only
from stratalake.session import materialise

FILTERS = "ABCDE"
COPY = 1 << 4  # E
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SLOTS, PROBES = 1 << 18, 3  # counters of a shard, and of a text
PER_SHARD = SLOTS >> 4


def failures(text: Column) -> Column:
    """Bits of A to D: few words, repeated words, many capitals, markup characters."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")  # noqa: PLC1901
    bits = F.transform(
        F.array(F.struct(F.size(words).alias("all"), F.size(F.array_distinct(words)).alias("distinct"))),
        lambda n: F.when(n["all"] < 100, 1).otherwise(0) + F.when(100 * n["distinct"] < 80 * n["all"], 2).otherwise(0),
    )[0]
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return (
        bits
        + F.when(100 * capitals > 10 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def _places(h: np.ndarray) -> np.ndarray:
    """The counters of hashes within their shard, one column for each probe."""
    mixed = h.astype(np.uint64)[:, None] * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(64 - 18)).astype(np.int64)


class CountingBloom:
    """Counters of one shard. They stop at 255, far above the 2 that makes a text suspect."""

    def __init__(self) -> None:
        self.counters = np.zeros(SLOTS, np.uint8)

    def add(self, places: np.ndarray, counts: np.ndarray) -> None:
        """Counters of a part of the data are added, each place once."""
        self.counters[places] = np.minimum(self.counters[places].astype(np.int64) + counts, 255)

    def maybe_repeated(self, h: np.ndarray) -> np.ndarray:
        """False only for hashes that came once."""
        return (self.counters[_places(h)] >= 2).all(1)


def sketch(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counters of some hashes, in ascending order, without zeros. A hash counts once for each
    of its places, also where two of its probes meet."""
    places = np.sort(_places(h), 1)
    fresh = np.ones(places.shape, bool)
    fresh[:, 1:] = places[:, 1:] != places[:, :-1]
    at, of = np.unique(places[fresh], return_inverse=True)
    return at, np.minimum(np.bincount(of, np.repeat(counts, fresh.sum(1)), len(at)), 255).astype(np.int64)


def suspects(hashes: DataFrame) -> DataFrame:
    """Distinct values of the column ``h`` that may occur more than once; all that do are among them."""
    n = hashes.count()
    shards = 1 << max(0, (n // PER_SHARD).bit_length())

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(shard, places, counts, hashes): the sketches of a part, and the hashes to be looked up."""
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, counts = np.unique(np.concatenate(held), return_counts=True)
            shard = h.view(np.uint64) % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.diff(shard[order])) + 1
            for some in np.split(order, cut):
                at, count = sketch(h[some], counts[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(shard[some[0]])], pa.int64()),
                        pa.array([at.astype("<u4").tobytes()], pa.binary()),
                        pa.array([count.astype(np.uint8).tobytes()], pa.binary()),
                        pa.array([h[some].astype("<i8").tobytes()], pa.binary()),
                    ],
                    ["shard", "places", "counts", "hashes"],
                )
            held.clear()

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            size += batch.num_rows
            if size >= 1 << 20:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    def probe(parts: pa.Table) -> pa.Table:
        merged = CountingBloom()
        for at, count in zip(parts.column("places"), parts.column("counts"), strict=True):
            merged.add(np.frombuffer(at.as_py(), "<u4").astype(np.int64), np.frombuffer(count.as_py(), np.uint8))
        found = [h[merged.maybe_repeated(h)] for h in (np.frombuffer(x.as_py(), "<i8") for x in parts.column("hashes"))]
        return pa.table({"h": pa.array(np.unique(np.concatenate(found)), pa.int64())})

    parts = hashes.select("h").mapInArrow(build, "shard long, places binary, counts binary, hashes binary")
    return parts.groupBy("shard").applyInArrow(probe, "h long")


def _repeats(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` (id, text, h, ...) whose text a row with a smaller id has as well, found by whole texts."""
    maybe = only(docs, ids, "h")
    least = maybe.groupBy("text").agg(F.min("id").alias("id"))  # one row a task and text is shuffled
    # the id is part of the key, so that the copies of one text go to many tasks
    return maybe.filter("id is not null").join(least.filter("id is not null"), ["id", "text"], "left_anti")


def _steps() -> Column:
    """Every step of every order: its filter, and the filters before."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    rows = [
        F.struct(
            F.lit(o).alias("filter_order"),
            F.lit(k + 1).alias("step"),
            F.lit(bit[f]).alias("bit"),
            F.lit(sum(bit[x] for x in o[:k])).alias("before"),
        )
        for o in ORDERS
        for k, f in enumerate(o)
    ]
    return F.array(*rows)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """600 rows per part: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null texts and parts count as empty. A row fails E if a smaller id has the same text anywhere in the
    table; a row without an id never does, rows that repeat id and text do not fail by one another. Documents
    without a label are neither good nor toxic; of repeated labels of an id one 1 is enough. Parts without
    documents do not exist, so no documents give no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("h", F.xxhash64("text"))
    light = materialise(rows.select("id", "part", "h", failures(F.col("text")).alias("mask")), "filter-flags")
    ids = materialise(suspects(light), "suspects")
    copies = _repeats(rows, ids).select("id", "part", failures(F.col("text")).alias("mask"))
    # a copy leaves the mask that it was counted under for the one with E
    moved = copies.select(
        "id",
        "part",
        F.explode(F.array(F.struct("mask", F.lit(-1).alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), F.lit(1).alias("n")))).alias("x"),
    ).select("id", "part", "x.mask", "x.n")
    marks = (
        labels.groupBy(F.col(id_col).alias("id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .filter("id is not null")
    )
    cells = (
        light.select("id", "part", "mask", F.lit(1).alias("n"))
        .unionByName(moved)
        .join(marks, "id", "left")
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )
    every = cells.select("part", "mask", "n", "good", "toxic", F.explode(_steps()).alias("s")).select("*", "s.*")
    here = F.col("mask").bitwiseAND(F.col("bit")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda what, when: F.sum(F.when(when, F.col(what)).otherwise(0)).cast("long")
    figures = every.groupBy("part", "filter_order", "step", "bit").agg(
        total("n", ~here & ~earlier).alias("kept"),
        total("n", here & ~earlier).alias("removed"),
        total("n", here & earlier).alias("redundant"),
        total("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        total("good", here & ~earlier).alias("good_lost"),
        total("toxic", here & ~earlier).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit"))  # 120 rows
    return figures.withColumn("shapley", shapley).drop("bit")
