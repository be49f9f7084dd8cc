"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import materialise


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as edges to the smallest node of each of its own components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = np.array(list(parent), np.int64)
    roots = np.array([root(x) for x in parent], np.int64)
    for lo in range(0, len(nodes), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[lo : lo + 100_000]), pa.array(roots[lo : lo + 100_000])], ["a", "b"])


def _stars(edges: DataFrame) -> bool:
    """Whether every node points to one node and that to none: with edges to smaller nodes, the components."""
    if not edges.groupBy("a").count().filter("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its smallest node.

    Edges and labels stay distributed; each round is written to the shared folder. A hot node's edges are
    reduced to a minimum on the map side, and no group of neighbours is ever gathered.
    """
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    edges = materialise(edges.mapInArrow(_forest, "a long, b long").filter("a <> b").distinct(), "forest")
    while not _stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # every edge now points to a smaller node
        large = materialise(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = materialise(small.union(least.select("u", "m")).distinct(), "small")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", "node"))
