"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of consecutive benchmark words. A table of shifts, addressed by the last
two words at a position, tells how far the search may move without missing a window; where it may
not move, the bucket of windows with the same last words is compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import in_batches, raw, schema_of, slices
from stratalake.session import materialise

# bytes to words: A-Z lower-cased, ASCII other than letters and digits to a blank, the rest as it is
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
BLOCK_BYTES = 4 << 20  # of benchmark text; its patterns take some sixty times as much in the driver, twenty in a broadcast
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class WuManber:
    """All windows of one length ``m`` over word numbers (0: a word of no window)."""

    def __init__(self, windows: np.ndarray, table_bits: int = 20):
        self.windows = windows
        self.m = m = windows.shape[1]
        self.block = min(2, m)
        self.tail = min(4, m)
        self.bits = table_bits
        self.shift = np.full(1 << table_bits, m - self.block + 1, np.int32)
        for end in range(self.block - 1, m):  # later positions allow smaller shifts
            where = self._address(windows, end)
            np.minimum.at(self.shift, where, m - 1 - end)
        keys = self._tail_key(windows, np.full(len(windows), m - 1), np.arange(len(windows)))
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def _address(self, rows: np.ndarray, end: int) -> np.ndarray:
        last = rows[:, end].astype(np.uint64) * _MIX[0]
        if self.block == 2:
            last ^= (rows[:, end - 1].astype(np.uint64) + np.uint64(1)) * _MIX[1]
        return (last >> np.uint64(64 - self.bits)).astype(np.int64)

    def _address_at(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        last = text[at].astype(np.uint64) * _MIX[0]
        if self.block == 2:
            last ^= (text[at - 1].astype(np.uint64) + np.uint64(1)) * _MIX[1]
        return (last >> np.uint64(64 - self.bits)).astype(np.int64)

    def _tail_key(self, text: np.ndarray, end: np.ndarray, row: np.ndarray | None = None) -> np.ndarray:
        """A hash of the last words: of the suffix bucket."""
        key = np.zeros(len(end), np.uint64)
        for k in range(self.tail):
            word = text[row, end - k] if row is not None else text[end - k]
            key = (key + word.astype(np.uint64) + np.uint64(1)) * _MIX[k % 2]
            key ^= key >> np.uint64(29)
        return key

    def search(self, text: np.ndarray, stretch: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(end position, window) of every occurrence; stretches of the text are searched side by side."""
        at = np.arange(self.m - 1, len(text), stretch)
        until = np.minimum(at + stretch, len(text))
        ends, which = [], []
        while len(at):
            step = self.shift[self._address_at(text, at)]
            here = at[step == 0]
            if len(here):
                e, w = self._compare(text, here)
                ends.append(e)
                which.append(w)
            at = at + np.maximum(step, 1)
            going = at < until
            at, until = at[going], until[going]
        none = np.zeros(0, np.int64)
        return (np.concatenate(ends), np.concatenate(which)) if ends else (none, none)

    def _compare(self, text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self._tail_key(text, at)
        lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        size = hi - lo
        end = np.repeat(at, size)
        w = self.order[np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        for k in range(self.m):
            same = text[end - k] == self.windows[w, self.m - 1 - k]
            end, w = end[same], w[same]
        return end, w


class Patterns:
    """The windows of some benchmark items, by length, with the items that have each."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                named = owners.setdefault(tuple(ids[i : i + m]), set())
                if item is not None:
                    named.add(item)
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for w in owners:
            by_length.setdefault(len(w), []).append(w)
        self.engines = [
            (WuManber(np.array(ws, np.int64)), [sorted(owners[w]) for w in ws]) for _, ws in sorted(by_length.items())
        ]

    def find(self, texts: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """For each text the hit words as (first, past last) spans, and the items that occur."""
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        found: list[set[str]] = [set() for _ in texts]
        get = self.number.get
        gap = 1  # a 0 between texts: no window crosses it
        sizes = np.array([len(t) + gap for t in texts], np.int64)
        start = np.cumsum(sizes) - sizes
        line = np.zeros(int(sizes.sum()), np.int64)
        for s, t in zip(start, texts, strict=True):
            line[s : s + len(t)] = np.fromiter((get(w, 0) for w in t), np.int64, len(t))
        edge = np.zeros(len(line) + 1, np.int32)
        hit_any = False
        for engine, owners in self.engines:
            end, which = engine.search(line)
            if len(end):
                hit_any = True
                np.add.at(edge, end - engine.m + 1, 1)
                np.add.at(edge, end + 1, -1)
                doc = np.searchsorted(start, end, "right") - 1
                for d, w in np.unique(np.stack([doc, which], 1), axis=0).tolist():
                    found[d].update(owners[w])
        if hit_any:
            hit = np.cumsum(edge[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
            for a, b in turn.reshape(-1, 2).tolist():  # texts are parted by a word that is never hit
                d = int(np.searchsorted(start, a, "right")) - 1
                spans[d].append((a - int(start[d]), b - int(start[d])))
        return spans, found


def _found(spans: list[list[tuple[int, int]]], items: list[set[str]], n_words: list[int]) -> list[pa.Array]:
    names = [sorted(x) for x in items]
    return [
        pa.array(n_words, pa.int64()),
        pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
        pa.array([len(x) for x in names], pa.int64()),
        pa.array(names, pa.list_(pa.string())),
        pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
        pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())),
    ]


_REST = "n_words long, n_hit long, n_items long, items array<string>, hit_from array<long>, hit_to array<long>"
_NAMES = ["n_words", "n_hit", "n_items", "items", "hit_from", "hit_to"]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """(item, text, block) of the benchmark and the number of blocks, of ``block_bytes`` of text each."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), raw(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks))), n_blocks


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items, hit_from, hit_to.

    ``hit_from`` and ``hit_to`` are the spans of hit words. Null and empty texts have no words and no
    hits; items without words match nothing; the words of items without an id are hit, but such items are neither
    listed nor counted; repeated rows are judged alike. An item shorter than ``window`` words is one window. Benchmarks beyond ``block_bytes`` are searched block by
    block, so what is broadcast stays below that bound, and the findings of a text are joined.
    """
    spark = docs.sparkSession
    items, n_blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    rows = docs.select(F.col(id_col), raw(text_col).alias("__text"))
    if n_blocks > 1:
        rows = materialise(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    kept = rows.columns
    parts = []
    for k in range(n_blocks):
        mine = items.filter(F.col("block") == k).collect()
        shared = spark.sparkContext.broadcast(Patterns([(r[0], bytes(r[1])) for r in mine], window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = shared.value
            for batch in slices(batches, 1):
                texts = [words_of(t) for t in batch.column(1).to_pylist()]
                got = _found(*patterns.find(texts), [len(t) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(batch.num_columns) if i != 1] + got,
                    [c for c in kept if c != "__text"] + _NAMES,
                )

        extra = "__row long, " if n_blocks > 1 else ""
        parts.append(in_batches(rows, run, schema_of(docs, id_col, extra + _REST)))
    if n_blocks == 1:
        return parts[0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    # one row per block and text: at most n_blocks rows in a group
    spans = F.sort_array(F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to"))))
    joined = every.groupBy("__row").agg(
        F.first(id_col).alias(id_col),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.aggregate(
            spans,
            F.array().cast("array<struct<hit_from:bigint,hit_to:bigint>>"),
            lambda done, s: F.when(
                (F.size(done) > 0) & (F.element_at(done, -1)["hit_to"] >= s["hit_from"]),
                F.concat(
                    F.slice(done, F.lit(1), F.size(done) - 1),
                    F.array(
                        F.struct(
                            F.element_at(done, -1)["hit_from"].alias("hit_from"),
                            F.greatest(F.element_at(done, -1)["hit_to"], s["hit_to"]).alias("hit_to"),
                        )
                    ),
                ),
            ).otherwise(F.concat(done, F.array(F.struct(s["hit_from"].alias("hit_from"), s["hit_to"].alias("hit_to"))))),
        ).alias("spans"),
    )
    return joined.select(
        id_col,
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hit_to"] - s["hit_from"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.col("spans.hit_from").alias("hit_from"),
        F.col("spans.hit_to").alias("hit_to"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns kept; the judgement is made row by row.

    The search runs beside the columns of the row, so nothing is joined or shuffled.
    """
    spark = docs.sparkSession
    window = options.get("window", 10)
    items, n_blocks = _blocks(benchmark, "item_id", "text", options.get("block_bytes", BLOCK_BYTES))
    names, at = docs.columns, docs.columns.index(text_col)
    left = docs
    for k in range(n_blocks):
        mine = items.filter(F.col("block") == k).collect()
        shared = spark.sparkContext.broadcast(Patterns([(r[0], bytes(r[1])) for r in mine], window))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, at):
                texts = [words_of(t or b"") for t in batch.column(at).cast(pa.binary()).to_pylist()]
                spans = shared.value.find(texts)[0]
                yield batch.filter(pa.array([not s for s in spans], pa.bool_()))

        left = in_batches(left, keep, docs.schema)
    return left.select(names)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
