"""Token counts by a public tokenizer, with huge documents encoded in overlapping chunks.

A chunk that begins in the middle of a text may cut its first words wrongly, and one that ends there its
last. The pre-tokenizer reads from left to right and remembers nothing, so from a place where both of two
overlapping chunks begin a word, far enough from the end of the first, both go on alike: such a border
is proven, and the counts are spliced there. Where two chunks share none, the text is cut again with a
wider overlap, at last as a whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import plain_words, raw, schema_of, slices, unsure
from stratalake.session import materialise


class Counter(dict):
    """The library's tokenizer without truncation, padding and begin or end tokens.

    Remembers how many tokens a word has, for up to ``max_words``; a word is encoded without its neighbours.
    """

    def __init__(self, path: str, max_words: int = 300_000):
        super().__init__()
        self.max_words = max_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        end_margin(path)  # words can be told apart
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)).search if special else lambda text: None

    def __missing__(self, word: str) -> int:
        n = len(self.tokenizer.encode(word, add_special_tokens=False).ids)
        if len(word) <= 64:
            if len(self) >= self.max_words:
                self.clear()
            self[word] = n
        return n

    def count(self, text: str) -> int:
        if self.special(text) or unsure(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, plain_words(text)))

    def words(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of tokens; the places where words begin and the tokens before each."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
        at = np.array([a for a, _ in e.offsets], np.int64)[first]
        return len(word), at, first


def end_margin(path: str) -> int:
    """How far before the end of a chunk words are as in the whole text.

    A special string may go on behind the end; a word depends on two characters behind it. Only for
    vocabularies whose words are found from left to right without memory.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    before = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        raise ValueError("only byte-level vocabularies without a normalizer or an added blank can be cut into chunks")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that take in or look at their neighbours cannot be cut into chunks")
    return max((len(t["content"]) for t in spec["added_tokens"]), default=0) + 4


def chunks_of(length: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Begin and end of chunks that cover ``length`` characters, each sharing ``overlap`` with the next."""
    step = chunk - overlap
    n = max(1, -(-(length - overlap) // step))
    return [(k * step, min(k * step + chunk, length)) for k in range(n)]


def _chunked(huge: DataFrame, path: str, chunk: int, overlap: int, margin: int) -> DataFrame:
    """(row, piece, last, n, left_at, left_before, right_at, right_before): what each chunk says of its two borders."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                spans = chunks_of(len(text), chunk, overlap)
                for k, (a, b) in enumerate(spans):  # one at a time, so that a text is in memory twice at most
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "piece": k, "last": k + 1 == len(spans), "start": a, "text": text[a:b]}],
                        schema=pa.schema([("row", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("start", pa.int64()), ("text", pa.string())]),
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        places = pa.list_(pa.int64())
        out = pa.schema([("row", pa.int64()), ("piece", pa.int64()), ("last", pa.bool_()), ("n", pa.int64()), ("left_at", places), ("left_before", places), ("right_at", places), ("right_before", places)])
        for batch in batches:
            for r in range(batch.num_rows):
                row, piece, last, start, text = (batch.column(c)[r].as_py() for c in range(5))
                n, at, before = counter.words(text)
                left = at <= overlap if piece else np.zeros(len(at), bool)
                right = (at >= len(text) - overlap) & (at <= len(text) - margin) if not last else np.zeros(len(at), bool)
                yield pa.RecordBatch.from_pylist(
                    [{"row": row, "piece": piece, "last": last, "n": n, "left_at": at[left] + start, "left_before": before[left], "right_at": at[right] + start, "right_before": before[right]}],
                    schema=out,
                )

    pieces = huge.select("row", "text").mapInArrow(cut, "row long, piece long, last boolean, start long, text string")
    # the chunks of one text go to many tasks
    spread = pieces.repartition(F.col("row"), F.col("piece"))
    return spread.mapInArrow(
        encode,
        "row long, piece long, last boolean, n long, left_at array<long>, left_before array<long>, right_at array<long>, right_before array<long>",
    )


def _spliced(pieces: DataFrame) -> DataFrame:
    """(row, n_tokens), null where some border has no proven place. Every border gives what is counted twice there."""
    ends = pieces.filter("not last").select("row", "piece", "n", "right_at", "right_before")
    begins = pieces.filter("piece > 0").select("row", (F.col("piece") - 1).alias("piece"), "left_at", "left_before")
    at = F.array_min(F.array_intersect("right_at", "left_at"))
    before = lambda places, counts: F.element_at(counts, F.array_position(places, F.col("at")).cast("int"))
    twice = ends.join(begins, ["row", "piece"]).withColumn("at", at)
    twice = twice.select(
        "row",
        (before("right_at", "right_before") - F.col("n") - before("left_at", "left_before")).alias("n"),
        F.col("at").isNull().cast("int").alias("open"),
    )
    every = pieces.select("row", "n", F.lit(0).alias("open")).unionByName(twice)
    done = every.groupBy("row").agg(F.sum("n").alias("n"), F.sum("open").alias("open"))
    return done.select("row", F.when(F.col("open") == 0, F.col("n")).alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 512,
    chunk: int = 1 << 15,
    overlap: int = 1 << 10,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    The count is the library's for the whole text, special strings in it included. Null counts as empty and
    has no tokens; repeated rows and ids are counted row by row; other columns are not read. Texts beyond
    ``chunk`` characters are encoded in chunks that many tasks share; ``path`` is read on each worker. A single
    word without any border, however long, is encoded in one piece, as the library does.
    """
    margin = end_margin(path)
    if overlap < 2 * margin or chunk < 2 * overlap:
        raise ValueError("chunks of at least two overlaps, overlaps of at least two margins")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in slices(batches, 2, 1 << 20):
            texts = [t.decode("utf-8", "replace") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pc.binary_length(batch.column(2)).cast(pa.int64()),
                    pa.array([counter.count(t) if len(t) <= chunk else None for t in texts], pa.int64()),
                    pa.array([None if len(t) <= chunk else t for t in texts], pa.string()),
                ],
                ["row", id_col, "n_bytes", "n_tokens", "text"],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), raw(text_col).alias("__text"))
    once = materialise(
        numbered.mapInArrow(first, "row long, " + schema_of(docs, id_col, "n_bytes long, n_tokens long, text string")), "token-counts"
    )
    result = lambda df: df.select(id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    counted = result(once.filter("n_tokens is not null"))
    huge = once.filter("text is not null").select("row", "text")
    left = huge.limit(1).count()
    while left:
        # written, because a chunk is read as the left and as the right one of two
        pieces = materialise(_chunked(huge, path, chunk, overlap, margin), "token-chunks")
        done = materialise(_spliced(pieces), "token-splices")
        ready = once.drop("n_tokens", "text").join(done.filter("n_tokens is not null"), "row")
        counted = counted.unionByName(result(ready))
        still = done.filter("n_tokens is null").select("row")
        left = still.limit(1).count()
        huge = huge.join(still, "row", "left_semi")
        overlap *= 8
        chunk = max(chunk, 4 * overlap)
    return counted
