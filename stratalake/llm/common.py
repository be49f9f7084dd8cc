"""Helpers shared by the operators: tables, ASCII lower case, Arrow batches, bounded collection."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed value: the pattern that byte-level vocabularies cut texts with.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Characters whose class every version of Unicode agrees on. ``unsure`` finds another one; in texts without any,
# ``plain_words`` cuts as BYTE_LEVEL does.
_LETTERS, _BLANKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", " \\t\\n\\r"
_SIGNS = "!-/:-@\\[-`{-~\u00a1\u00a7\u00ab\u00bb\u00bf\u00d7\u00f7\u2013\u2014\u2018-\u201f\u2026\u20ac"
unsure = re.compile(f"[^{_LETTERS}{_BLANKS}0-9{_SIGNS}]").search
plain_words = re.compile(
    f" ?[{_LETTERS}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_SIGNS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
).findall


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def raw(text_col: str) -> Column:
    """A text as UTF-8 bytes, null as no bytes; no decoding on the way to Python."""
    return F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))


def held_out(id_col: str) -> Column:
    """Rows that no classifier may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def only(rows: DataFrame, ids: DataFrame, key: str, small: int = 1_000_000) -> DataFrame:
    """``rows`` whose ``key`` is among ``ids`` (one column of that name, distinct, already written).

    Up to ``small`` ids, which are counted, are broadcast and the rows stay where they are; more are joined by
    a shuffle, with the same result.
    """
    return rows.join(F.broadcast(ids) if ids.count() <= small else ids, key, "left_semi")


_kept: dict[Hashable, object] = {}  # at most one object, for later tasks of the same kind in this worker


def kept[T](key: Hashable, make: Callable[[], T]) -> T:
    """An object that is costly to make; it stays until ``release``, or until another one takes its place."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Drop what earlier tasks of this worker kept and give the free memory back to the system.

    Workers are reused by all stages, so what one stage leaves in them would add to the needs of the next.
    """
    _kept.clear()
    gc.collect()  # states that point at each other
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


BATCH_BYTES = 4 << 20


def in_batches(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over batches of at most ``BATCH_BYTES``, or one row beyond that.

    Spark bounds a batch by 10,000 rows and 64 MB, which texts fill; both the executor and its Python worker hold
    it whole. The limit is a setting of the session and stays; it never changes a result.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows.mapInArrow(run, schema)


def slices(
    batches: Iterable[pa.RecordBatch], text_at: int, max_bytes: int = 8 << 20, keep: bool = False
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``max_bytes`` of text (a longer text stands alone).

    Before the first one memory is released, but for what is ``kept`` if ``keep``.
    """
    if not keep:
        release()
    for batch in batches:
        start, held = 0, 0
        sizes = pc.binary_length(batch.column(text_at)).to_pylist() if batch.num_rows else []
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 0
        if start < batch.num_rows:
            yield batch.slice(start)


def schema_of(df: DataFrame, id_col: str, rest: str) -> str:
    return f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, {rest}"
