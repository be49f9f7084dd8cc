"""Toxicity by nearest labelled examples.

A bounded sample of labelled texts becomes TF-IDF vectors over all of its words; those that tell
the classes apart weigh more. An inverted index holds, for every word and block of examples, the largest weight; the sums
of these bound the cosine of a whole block, so blocks that cannot reach the k nearest are skipped
and the k nearest are exact. Their votes, weighted by distance, are calibrated on the sample itself
with each example left out.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, in_batches, raw, schema_of, slices
from stratalake.llm.decontaminate import words_of
from stratalake.session import materialise

BLOCK = 64


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges lo to hi, one after the other, and the range each is of."""
    size = hi - lo
    return np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size), np.repeat(np.arange(len(lo)), size)


class BlockMaxIndex:
    """Sparse unit vectors in an inverted index with the maxima of each block of ``BLOCK`` vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        row = np.repeat(np.arange(self.size), [len(t) for t, _ in vectors])
        order = np.lexsort((row, term))
        self.row, self.weight = row[order].astype(np.int32), weight[order]  # short numbers: every worker holds them
        # a cell holds the postings of a term in a block: from cell start[i] to start[i + 1]; cells of a term lie together
        cell = term[order] * (self.blocks + 1) + self.row // BLOCK
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
        self.start = np.r_[first, len(cell)].astype(np.int32 if len(cell) < 1 << 31 else np.int64)
        self.block = self.row[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.cells = np.searchsorted(term[order][first], np.arange(n_terms + 1))

    def _cosines(self, cells: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a cosine above 0 over the postings of some cells, each with the weight of its term."""
        at, of = _ranges(self.start[cells], self.start[cells + 1])
        score = np.bincount(self.row[at], weights[of] * self.weight[at], self.size)
        some = np.flatnonzero(score > 0)
        return some, score[some]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of highest cosine above 0 and their cosines; ties go to the lower row.

        The most promising blocks are summed first; of the others only those whose bound reaches the
        k-th cosine found there.
        """
        rows, cosines = np.zeros(0, np.int64), np.zeros(0)
        if not len(terms):
            return rows, cosines
        cells, of = _ranges(self.cells[terms], self.cells[terms + 1])
        there, weight = self.block[cells], weights[of]
        bound = np.bincount(there, weight * self.most[cells], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        done = 0
        while done < len(order):
            if len(rows) == k:
                reach = bound[order[done:]] >= cosines[-1] - 1e-9
                now = order[done:][reach]  # bounds fall, so nothing behind reaches either
                done = len(order)
            else:
                now = order[done : done + max(8, done)]
                done += len(now)
            if not len(now):
                break
            chosen = np.zeros(self.blocks, bool)
            chosen[now] = True
            chosen = chosen[there]
            more, found = self._cosines(cells[chosen], weight[chosen])
            if without >= 0:
                more, found = more[more != without], found[more != without]
            rows, cosines = np.concatenate([rows, more]), np.concatenate([cosines, found])
            rounded = np.round(cosines, 9)
            if len(rows) > k:  # all that tie with the k-th stay until the sort
                keep = rounded >= np.partition(rounded, -k)[-k]
                rows, cosines, rounded = rows[keep], cosines[keep], rounded[keep]
            best = np.lexsort((rows, -rounded))[:k]
            rows, cosines = rows[best], cosines[best]
        return rows, cosines


def vector(text: bytes, number: dict[bytes, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms in ascending order and weights (1 + ln tf) * idf of unit length; ``idf`` may hold another factor too."""
    tf = Counter(i for w in words_of(text) if (i := number.get(w)) is not None)
    terms = np.array(sorted(tf), np.int64)
    weights = np.array([(1 + math.log(tf[i])) * idf[i] for i in terms.tolist()], float)
    return terms, weights / np.sqrt((weights**2).sum()) if len(terms) else weights


def rising(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic fit by pooling neighbours that fall: knots and values."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), w[order].tolist(), strict=True):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            p = pools.pop()
            pools[-1] = [s + t for s, t in zip(pools[-1], p, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


class Model:
    """Fitted examples; small, of bounded size, sent to every worker."""

    def __init__(self, terms: list[bytes], idf: np.ndarray, examples: list[tuple], share: dict[int, float], k: int):
        """examples: (id, label, terms, weights); share: how many labelled rows an example of a label stands for."""
        self.number = {t: i for i, t in enumerate(terms)}
        self.idf, self.k = idf, k
        empty = [e for e in examples if not len(e[2])]
        full = [e for e in examples if len(e[2])]
        # alike examples side by side, so that blocks have low maxima elsewhere
        full.sort(key=lambda e: (int(e[2][int(np.argmax(e[3]))]), str(e[0])))
        self.ids = [str(e[0]) for e in full]
        self.label = np.array([e[1] for e in full], float)
        self.share = np.array([share[e[1]] for e in full], float)
        self.index = BlockMaxIndex([(e[2], e[3]) for e in full], len(terms))
        mass = sum(share[e[1]] for e in empty)
        everything = sum(share[e[1]] for e in examples)
        self.prior = sum(share[e[1]] * e[1] for e in examples) / everything if everything else 0.0
        # texts without any word of the examples: as the examples without any
        self.blank = (sum(share[e[1]] * e[1] for e in empty) + self.prior) / (mass + 1)
        raw_scores = np.array([self._vote(*self.index.nearest(e[2], e[3], k, i)) for i, e in enumerate(full)])
        self.knots, self.values = rising(raw_scores, self.label, self.share) if full else (np.zeros(1), np.zeros(1))
        self._seen: dict[bytes, tuple] = {}

    def _vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Votes weighted by 1 / (distance + 0.1), with the prior as one far neighbour."""
        w = self.share[rows] / (1 - cosines + 0.1)
        return float(((w * self.label[rows]).sum() + self.prior) / (w.sum() + 1))

    def score(self, text: bytes) -> tuple[float, list[tuple[str, int, float]]]:
        """Score, and the nearest examples as evidence: (id, label, cosine)."""
        terms, weights = vector(text, self.number, self.idf)
        if not len(terms):
            return self.blank, []
        key = hashlib.blake2b(terms.tobytes() + weights.tobytes(), digest_size=16).digest()  # long texts leave short keys
        if key not in self._seen:
            if len(self._seen) > 10_000:
                self._seen.clear()
            rows, cosines = self.index.nearest(terms, weights, self.k)
            score = self.blank if not len(rows) else float(np.interp(self._vote(rows, cosines), self.knots, self.values))
            near = [(self.ids[r], int(self.label[r]), float(c)) for r, c in zip(rows[:3].tolist(), cosines[:3].tolist(), strict=True)]
            self._seen[key] = (min(max(score, 0.0), 1.0), near)
        return self._seen[key]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_per_label: int = 1500,
    least_chi2: float = 20.0,
    other: float = 0.3,
    k: int = 15,
) -> Model:
    """Examples: the ``max_per_label`` labelled rows of each label with the smallest hash of their id, rows
    held out never. All words of the examples are terms. Words that at least three examples have, with a
    chi-square of ``least_chi2`` against the label, weigh in full and the others ``other`` times as much (both, and
    ``k``, were chosen on folds of the rows to learn from). Repeated ids in ``docs`` or ``labels`` are as many examples. Document
    frequencies are counted over all of ``docs``. Only the words, counts and vectors of the examples reach the driver.
    """
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("id is not null")
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    picked = [
        known.filter(F.col("label") == v).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_per_label) for v in (0, 1)
    ]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * max_per_label rows of two numbers
    chosen = materialise(
        docs.select(F.col(id_col).alias("id"), raw(text_col).alias("text")).join(sample, "id"), "examples"
    )
    sizes = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    terms, chi2 = _words(chosen, sizes)
    idf = _idf(docs.select(raw(text_col).alias("text")), terms) * np.where(chi2 >= least_chi2, 1.0, other)
    shared = docs.sparkSession.sparkContext.broadcast(({t: i for i, t in enumerate(terms)}, idf))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, idf = shared.value
        for batch in slices(batches, 1):
            made = [vector(t, number, idf) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([a for a, _ in made], pa.list_(pa.int64())), pa.array([b for _, b in made], pa.list_(pa.float64()))],
                ["id", "label", "terms", "weights"],
            )

    schema = schema_of(chosen, "id", "label int, terms array<long>, weights array<double>")
    rows = in_batches(chosen.select("id", "text", "label"), vectors, schema).collect()
    examples = [(r["id"], r["label"], np.array(r["terms"], np.int64), np.array(r["weights"], float)) for r in rows]
    share = {v: totals[v] / sizes[v] for v in sizes}
    least = min(share.values(), default=1.0)
    return Model(terms, idf, examples, {v: s / least for v, s in share.items()}, k)


def _words(chosen: DataFrame, sizes: dict[int, int]) -> tuple[list[bytes], np.ndarray]:
    """All words of the examples in ascending order, and their chi-square; 0 for words that fewer than three have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in slices(batches, 0):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[label].update(set(words_of(text)))
        words = list(seen[0].keys() | seen[1].keys())
        for lo in range(0, len(words), 50_000):
            some = words[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.binary()), pa.array([seen[0][w] for w in some], pa.int64()), pa.array([seen[1][w] for w in some], pa.int64())],
                ["term", "n0", "n1"],
            )

    a, b = F.col("n1"), F.col("n0")
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    n = n1 + n0
    top = (a * (n0 - b) - b * (n1 - a)) ** 2 * n
    chi2 = top / ((a + b) * (n - a - b) * n1 * n0 + 1e-9)
    rows = (
        in_batches(chosen.select("text", "label"), count, "term binary, n0 long, n1 long")
        .groupBy("term")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .select("term", F.when(a + b >= 3, chi2).otherwise(0.0).alias("chi2"))
        .collect()
    )
    rows = sorted((bytes(r["term"]), r["chi2"]) for r in rows)
    return [t for t, _ in rows], np.array([x for _, x in rows], float)


def _idf(texts: DataFrame, terms: list[bytes]) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the word)) + 1, counted over all texts."""
    shared = texts.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seen, n = shared.value, Counter(), 0
        have = number.keys()
        for batch in slices(batches, 0):
            for text in batch.column(0).to_pylist():
                seen.update(w for w in set(words_of(text)) if w in have)
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *(number[w] for w in seen)], pa.int64()), pa.array([n, *seen.values()], pa.int64())], ["term", "n"]
        )

    counted = in_batches(texts, count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    df = np.array([found.get(i, 0) for i in range(len(terms))], float)
    return np.log((1 + found.get(-1, 0)) / (1 + df)) + 1


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score, evidence.

    Null and empty texts, and texts without any word of the examples, get the share of such examples that are
    labelled 1 and no evidence; without labels every score is 0. Repeated rows score alike; of examples with the
    same cosine those of the lower place in the index are the nearer ones.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("id", pa.string()), ("label", pa.int32()), ("cosine", pa.float64())]))
        for batch in slices(batches, 1):
            got = [shared.value.score(t) for t in batch.column(1).to_pylist()]
            near = [[{"id": i, "label": y, "cosine": c} for i, y, c in e] for _, e in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s for s, _ in got], pa.float64()), pa.array(near, kind)], [id_col, "score", "evidence"]
            )

    rest = "score double, evidence array<struct<id:string,label:int,cosine:double>>"
    return in_batches(docs.select(F.col(id_col), raw(text_col).alias("__text")), run, schema_of(docs, id_col, rest))


def reject(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept, row by row without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([shared.value.score(t or b"")[0] < threshold for t in texts], pa.bool_()))

    return in_batches(docs, run, docs.schema)
