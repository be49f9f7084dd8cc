"""Exact dedup with counting quotient filters.

Every partition builds a counting quotient filter of its 64-bit fingerprints, cut into blocks by
the leading bits. Filters of one block are merged by their sorted remainders, without loss, and
only fingerprints counted more than once route their texts to the comparison of bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import materialise

WHITE_SPACE = "[\\x20\\x09-\\x0D]"
DIGIT_BITS = 16  # a counter slot holds that many bits of a count


class QuotientFilter:
    """Sorted distinct values of ``width`` bits with counts, as slots of remainders.

    The leading ``q`` bits of a value are its quotient, the others its remainder. ``occupied`` has
    a bit for each quotient in use; slots hold the remainders of one quotient after the other in
    ascending order, ``run_end`` marks the last slot of a quotient. A value counted more than once
    is followed by slots marked ``counter`` with the digits of its count less one. Width is the
    same everywhere, so filters of unequal ``q`` hold the same values and merge exactly.
    """

    def __init__(self, values: np.ndarray, counts: np.ndarray, width: int):
        self.values, self.counts, self.width = values.astype(np.uint64), counts.astype(np.int64), width

    @classmethod
    def of(cls, fingerprints: np.ndarray, width: int) -> QuotientFilter:
        return cls(*np.unique(fingerprints.astype(np.uint64), return_counts=True), width)

    @classmethod
    def merge(cls, filters: Iterable[QuotientFilter]) -> QuotientFilter:
        """One filter with the summed counts; runs that are sorted already are merged, not re-sorted."""
        filters = list(filters)
        values = np.concatenate([f.values for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
        return cls(values[first], np.add.reduceat(counts, first) if len(first) else counts, filters[0].width)

    def to_bytes(self) -> bytes:
        n = len(self.values)
        q = min(self.width - 1, max(1, math.ceil(math.log2(n + 1))))
        r = self.width - q
        quotient = (self.values >> np.uint64(r)).astype(np.int64)
        remainder = self.values & np.uint64((1 << r) - 1)
        extra, left = np.zeros(n, np.int64), self.counts - 1
        while (left > 0).any():
            extra += left > 0
            left >>= DIGIT_BITS
        at = np.cumsum(extra + 1) - (extra + 1)
        total = int((extra + 1).sum())
        slots, counter, run_end = np.zeros(total, np.uint64), np.zeros(total, bool), np.zeros(total, bool)
        slots[at] = remainder
        left = self.counts - 1
        for d in range(1, int(extra.max(initial=0)) + 1):
            some = extra >= d
            slots[at[some] + d] = (left[some] & ((1 << DIGIT_BITS) - 1)).astype(np.uint64)
            counter[at[some] + d] = True
            left = left >> DIGIT_BITS
        last = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True]) if n else np.zeros(0, int)
        run_end[at[last] + extra[last]] = True
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        size = (max(r, DIGIT_BITS) + 7) // 8
        body = slots.astype("<u8").view(np.uint8).reshape(total, 8)[:, :size].tobytes()
        return b"".join(
            (np.array([self.width, q, total, size], "<i8").tobytes(), np.packbits(occupied).tobytes(),
             np.packbits(run_end).tobytes(), np.packbits(counter).tobytes(), body)
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        width, q, total, size = (int(x) for x in np.frombuffer(data, "<i8", 4))
        at = 32

        def bits(n: int) -> np.ndarray:
            nonlocal at
            got = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at), count=n).astype(bool)
            at += (n + 7) // 8
            return got

        occupied, run_end, counter = bits(1 << q), bits(total), bits(total)
        slots = np.zeros((total, 8), np.uint8)
        slots[:, :size] = np.frombuffer(data, np.uint8, total * size, at).reshape(total, size)
        slots = slots.view("<u8").ravel().astype(np.uint64)
        start = np.flatnonzero(~counter)
        run = np.cumsum(run_end) - run_end  # ends before this slot: the rank of its quotient
        quotient = np.flatnonzero(occupied)[run[start]].astype(np.uint64)
        values = (quotient << np.uint64(width - q)) | slots[start]
        counts = np.ones(len(start), np.int64)
        of = np.cumsum(~counter) - 1
        depth = np.arange(total) - start[of] if total else np.zeros(0, int)
        digit = np.flatnonzero(counter)
        np.add.at(counts, of[digit], slots[digit].astype(np.int64) << (DIGIT_BITS * (depth[digit] - 1)))
        return cls(values, counts, width)


def repeated_fingerprints(rows: DataFrame, fp_col: str, n_rows: int, per_block: int = 1 << 19) -> DataFrame:
    """(fingerprint, n) of all fingerprints that occur more than once in ``rows``.

    Each task sends one filter per block; the number of blocks grows with ``n_rows``, so a block
    has about ``per_block`` fingerprints at most and a hot fingerprint one counted value per task.
    """
    spark = rows.sparkSession
    wanted = max(n_rows // per_block, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = min(30, max(1, math.ceil(math.log2(wanted))))
    width = 64 - bits

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches if b.num_rows]
        if not parts:
            return
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        block = (values >> np.uint64(width)).astype(np.int64)
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        low = values & np.uint64((1 << width) - 1)
        for lo in range(0, len(edges), 1024):
            some = edges[lo : lo + 1024]
            until = np.r_[edges, len(values)][lo + 1 : lo + 1025]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[some], pa.int64()),
                    pa.array(
                        [QuotientFilter(low[a:b], counts[a:b], width).to_bytes() for a, b in zip(some, until, strict=True)],
                        pa.binary(),
                    ),
                ],
                ["block", "filter"],
            )

    def merged(key: tuple, pieces: pa.Table) -> pa.Table:
        whole = QuotientFilter.merge(QuotientFilter.from_bytes(x) for x in pieces.column("filter").to_pylist())
        many = whole.counts > 1
        values = whole.values[many] | np.uint64(key[0].as_py() << width)
        return pa.table({fp_col: values.view(np.int64), "n": whole.counts[many]})

    pieces = rows.select(fp_col).mapInArrow(build, "block long, filter binary")
    return pieces.groupBy("block").applyInArrow(merged, f"`{fp_col}` long, n long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, n_chars.

    Texts are equal when they are after deleting ASCII white space; null counts as empty, and empty
    texts are equal to each other. Of equal texts the longest original stays, then the smallest id
    (null ids last), then, of rows repeated with the same id, one of them. Other columns are not read.
    No text leaves its task unless its fingerprint occurs twice; groups are counted on the map side
    before they are shuffled, so a group may hold any share of the rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    squeezed = docs.select(
        F.col(id_col).alias("id"),
        F.char_length(text).cast("long").alias("n_chars"),
        F.regexp_replace(text, WHITE_SPACE, "").alias("body"),
    )
    printed = squeezed.withColumn("fp", F.xxhash64("body"))
    light = materialise(
        printed.select("id", "n_chars", "fp", F.sha2("body", 256).alias("sha")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "prints",
    )
    many = materialise(repeated_fingerprints(light, "fp", light.count()), "repeated")
    # bytes are compared by grouping on them; equal digests of unequal bytes would show as two rows
    proved = materialise(
        printed.select("fp", "body")
        .join(many.select("fp"), "fp", "left_semi")
        .groupBy("body")
        .agg(F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(F.sha2("body", 256).alias("sha"), "group_size"),
        "proved",
    )
    if not proved.groupBy("sha").count().filter("count > 1").isEmpty():
        raise ArithmeticError("two different texts have one SHA-256")
    best = (
        light.join(many.select("fp"), "fp", "left_semi")
        .groupBy("sha")
        .agg(F.min(F.struct(-F.col("n_chars"), F.col("id").isNull(), F.col("id").alias("id"), "row")).alias("best"))
        .join(proved, "sha")
        .select("sha", "group_size", F.col("best.id").alias("best_id"), F.col("best.row").alias("best_row"))
    )
    alone = F.col("group_size").isNull()
    return light.join(materialise(best, "best"), "sha", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("best_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "n_chars",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are found again by id and original length; where ids repeat, each text stays once.
    """
    groups = exact_groups(docs, id_col, text_col)
    gone = materialise(groups.filter(~F.col("kept")).select(id_col, "text_sha256"), "gone")
    if gone.groupBy(id_col).count().join(
        groups.filter("kept").select(id_col), id_col, "left_semi"
    ).isEmpty() and gone.filter(F.col(id_col).isNull()).isEmpty():
        return docs.join(gone.select(F.col(id_col)), id_col, "left_anti").select(docs.columns)
    # an id that both stays and goes names several rows: tell them apart by their text
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = docs.columns
    digest, longest, best = "__sha", "__chars", "__best"
    marked = docs.withColumn(digest, F.sha2(F.regexp_replace(text, WHITE_SPACE, ""), 256)).withColumn(
        longest, F.char_length(text).cast("long")
    )
    stay = groups.filter("kept").select(
        F.col(id_col).alias(best), F.col("text_sha256").alias(digest), F.col("n_chars").alias(longest)
    )
    found = marked.join(
        stay, (marked[id_col].eqNullSafe(stay[best])) & (marked[digest] == stay[digest]) & (marked[longest] == stay[longest]),
        "left_semi",
    )
    return found.dropDuplicates([id_col, digest, longest]).select(names)
