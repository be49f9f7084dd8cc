"""How far the sources of a language differ in their words.

Every source of a language becomes sorted arrays of (term id, count), cut into blocks of terms. A task for
each unordered pair and block walks the shorter array, gallops through the longer one and prices terms
that both, one or neither have; the sums over blocks are the distance of the two, in both directions.
All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm.common import raw
from stratalake.session import materialise

# bytes to terms: A-Z lower-cased, other ASCII than letters to a blank, the rest as it is
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
SMOOTH, SCALE = 5, 10**9  # SCALE: three steps of a thousand, see share()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def share(n, total, terms):
    """1 + floor(SCALE * (n + SMOOTH) / (total + SMOOTH * terms)) in 64 bits, three digits after the other."""
    top, bottom = n + SMOOTH, total + SMOOTH * terms
    p = 0
    for _ in range(3):
        p, top = p * 1000 + top * 1000 // bottom, top * 1000 % bottom
    return 1 + p


def share_sql(n: str, total: str, terms: str) -> Column:
    """``share`` as an expression; ``terms`` above 0."""
    bottom = f"({total} + {SMOOTH}L * {terms})"
    top, steps = f"({n} + {SMOOTH}L)", []
    for _ in range(3):
        steps.append(f"({top} * 1000L div {bottom})")
        top = f"({top} * 1000L % {bottom})"
    return F.expr(f"1L + {steps[0]} * 1000000L + {steps[1]} * 1000L + {steps[2]}")


def gallop(short: np.ndarray, long: np.ndarray, run: int = 64) -> np.ndarray:
    """For each of ``short`` its place in ``long`` or -1; both ascending without repeats.

    Runs of ``short`` step through ``long`` in doubling strides until past their last one, then each is
    found by halving within the last strides.
    """
    found = np.full(len(short), -1, np.int64)
    lo = 0
    for a in range(0, len(short), run):
        some = short[a : a + run]
        hi, stride = lo, run
        while hi < len(long) and long[hi] <= some[-1]:
            hi += stride
            stride *= 2
        hi = min(hi, len(long))
        at = lo + np.searchsorted(long[lo:hi], some)
        hit = at < hi
        hit[hit] = long[at[hit]] == some[hit]
        found[a : a + run][hit] = at[hit]
        lo = int(at[-1])
    return found


def price(ids_a, n_a, ids_b, n_b, total_a: int, total_b: int, terms: int) -> tuple[int, int]:
    """Sum of differences over the terms that one or both have, and how many these are."""
    if len(ids_a) > len(ids_b):
        return price(ids_b, n_b, ids_a, n_a, total_b, total_a, terms)
    at = gallop(ids_a, ids_b)
    both = at >= 0
    p, q = share(n_a, total_a, terms), share(n_b, total_b, terms)
    value = int(np.abs(p[both] - q[at[both]]).sum())
    value += int(np.abs(p[~both] - share(0, total_b, terms)).sum())
    alone = np.ones(len(ids_b), bool)
    alone[at[both]] = False
    value += int(np.abs(q[alone] - share(0, total_a, terms)).sum())
    return value, len(ids_a) + int(alone.sum())


def _count(docs: DataFrame, text_col: str, lang_col: str, source_col: str, max_terms: int = 200_000) -> DataFrame:
    """(lang, source, term, n, docs), summed within a task first; the term '' stands for the group itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in seen.items():
                terms = [b"", *n]
                for lo in range(0, len(terms), 20_000):
                    some = terms[lo : lo + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(some), pa.string()),
                            pa.array([source] * len(some), pa.string()),
                            pa.array(some, pa.binary()),
                            pa.array([n.get(t, 0) for t in some], pa.int64()),
                            pa.array([d.get(t, 0) for t in some], pa.int64()),
                        ],
                        ["lang", "source", "term", "n", "docs"],
                    )
            seen.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                n, d = seen.setdefault((lang, source), (Counter(), Counter()))
                terms = terms_of(text.as_py())
                before = len(n)
                n.update(terms)
                d.update(set(terms))
                held += len(n) - before + 1
                if held >= max_terms:
                    yield from flush()
                    held = 0
        yield from flush()

    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), raw(text_col).alias("text"))
    counted = given.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _priced(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """(lang, a, b, value, present): a row per pair, summed over the blocks of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)

        def numbers(column: pa.Array, r: int) -> np.ndarray:
            return column[r].values.to_numpy(zero_copy_only=False) if column[r].is_valid else none

        for batch in batches:
            total_a, total_b, terms = (batch.column(c).to_pylist() for c in (3, 4, 5))
            got = [
                price(*(numbers(batch.column(c), r) for c in (6, 7, 8, 9)), total_a[r], total_b[r], terms[r])
                for r in range(batch.num_rows)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(3)), pa.array([v for v, _ in got], pa.int64()), pa.array([k for _, k in got], pa.int64())],
                ["lang", "a", "b", "value", "present"],
            )

    def side(name: str) -> DataFrame:
        """The blocks of one side, once for each pair that it is in."""
        mine = arrays.select("lang", F.col("source").alias(name), "block", F.col("ids").alias(f"ids_{name}"), F.col("counts").alias(f"n_{name}"))
        return pairs.join(mine, ["lang", name]).select(*pairs.columns, "block", f"ids_{name}", f"n_{name}")

    # a block that only one of the two has is priced as well
    cells = side("a").join(side("b"), [*pairs.columns, "block"], "full_outer")
    columns = ["lang", "a", "b", "total_a", "total_b", "terms", "ids_a", "n_a", "ids_b", "n_b"]
    made = cells.select(*columns).mapInArrow(run, "lang string, a string, b string, value long, present long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("present").alias("present"))


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 30,
    top: int = 50,
    block_terms: int = 8192,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): distances to all other sources, and over-used terms.

    Part ``pair``: the sum over the kept terms of the language of the difference of both sources' smoothed
    shares, ranked from the farthest. Part ``term``: the ``top`` terms whose share in the source exceeds that
    in its language most. Kept are terms in at least ``min_docs`` documents of a language. Ties are ranked by
    item in byte order. Null text, lang and source count as empty strings; a group without terms has counts of
    0, a language without kept terms distances of 0; a source alone in its language has no pair; repeated rows
    count as often as they come; no documents give no rows. Other columns are not read. Exact below 9 * 10^15
    occurrences.
    """
    counted = materialise(_count(docs, text_col, lang_col, source_col), "term-counts")
    groups = counted.filter(F.octet_length("term") == 0).select("lang", "source")
    words = counted.filter(F.octet_length("term") > 0)
    vocabulary = materialise(
        words.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs"),
        "vocabulary",
    )
    blocks = max(1, -(-vocabulary.count() // block_terms))
    number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    numbered = vocabulary.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks))).withColumn("id", number.cast("long"))
    kept = materialise(words.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "kept-terms")

    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("total_lang"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = materialise(
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "total_lang"]),
        "sources",
    )

    # the result has a row for each pair of sources; none more is made here
    a = sources.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms")
    b = sources.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    pairs = a.join(b, "lang").filter("a < b").select("lang", "a", "b", "total_a", "total_b", "terms")
    arrays = (
        kept.groupBy("lang", "source", "block")
        .agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("have"))  # at most about block_terms of them
        .select("lang", "source", "block", F.col("have.id").alias("ids"), F.col("have.n").alias("counts"))
    )
    absent = F.abs(share_sql("0L", "total_a", "terms") - share_sql("0L", "total_b", "terms"))
    value = F.when(
        F.col("terms") > 0,
        F.coalesce("value", F.lit(0)) + (F.col("terms") - F.coalesce("present", F.lit(0))) * absent,
    ).otherwise(0)
    priced = pairs.join(_priced(pairs, arrays), ["lang", "a", "b"], "left").withColumn("value", value.cast("long"))
    ways = F.explode(
        F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int")
    distances = (
        priced.select("lang", "value", ways.alias("way"))
        .select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
        .withColumn("rank", rank)
    )

    more = share_sql("n", "total", "terms") - share_sql("n_lang", "total_lang", "terms")
    over = (
        kept.join(sources, ["lang", "source"])
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), more.alias("value"))
        .filter("value > 0")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= top)
    )
    return distances.unionByName(over)
