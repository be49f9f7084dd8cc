"""Quality by nearest neighbours in a latent-semantic space.

Texts become TF-IDF weights of hashed features (words, their shapes, lengths, lines, repetition).
A randomised singular value decomposition of a bounded sample gives the latent directions; labelled
vectors are broadcast, the cosines of every document to all of them are computed in exact matrix
products, block by block, and the labels of the nearest are weighted by similarity.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import held_out, raw, schema_of, slices
from stratalake.llm.toxicity import rising
from stratalake.session import materialise

WIDTH = 1 << 12  # hashed features
LONG = 24
_RUNS = re.compile(rb"(.)\1+", re.DOTALL).sub
_CLASS = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256)
)


class Features:
    """Texts to counts of hashed features; remembers the features of words, up to ``max_words``.

    A word gives itself in lower case, its shape (runs of a class as one), its last three bytes if it ends in a
    sign, and its length. Words beyond ``LONG`` bytes also give all their byte trigrams, so that no part of a
    text without blanks stays unread.
    """

    def __init__(self, max_words: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.slots = np.zeros((max_words, 4), np.int16)  # WIDTH: no feature
        self.max_words = max_words
        self.others: dict[tuple, list[int]] = {}

    @staticmethod
    def _slot(kind: bytes, value: bytes) -> int:
        return xxhash.xxh64_intdigest(kind + value) % WIDTH

    def _word(self, w: bytes) -> tuple[int, int, int, int]:
        """The word's slots; one that repeats another is left out."""
        classes = w.translate(_CLASS)
        last = w[-1]
        rest = (_RUNS(rb"\1", classes), b"" if last >= 0x80 or classes[-1] in b"aA0" else w[-3:], min(len(w), LONG) // 3)
        others = self.others.get(rest)
        if others is None:
            if len(self.others) >= self.max_words:
                self.others.clear()
            shape, ends, size = rest
            others = self.others[rest] = [self._slot(b"s", shape), self._slot(b"e", ends), self._slot(b"n", b"%d" % size)]
        slots = [xxhash.xxh64_intdigest(b"w" + w.lower()) % WIDTH, *others]
        return tuple(slots) if len(set(slots)) == 4 else (*set(slots), WIDTH, WIDTH, WIDTH)[:4]

    def _rows(self, words: list[bytes]) -> np.ndarray:
        """The features of some words, four each; at most ``max_words`` at a time."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.max_words:
            known.clear()
            new = words
        if new:
            start = len(known)
            self.slots[start : start + len(new)] = [self._word(w) for w in new]
            known.update(zip(new, range(start, start + len(new)), strict=True))
        return self.slots[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def count(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(slots in ascending order, counts)."""
        words = Counter(text.split())
        distinct = list(words)
        times = np.fromiter(words.values(), float, len(words))
        got = np.zeros(WIDTH + 1)
        for lo in range(0, len(distinct), self.max_words):
            rows = self._rows(distinct[lo : lo + self.max_words])
            got += np.bincount(rows.ravel(), np.repeat(times[lo : lo + self.max_words], 4), WIDTH + 1)
        for w in distinct:
            if len(w) > LONG:
                b = np.frombuffer(w.lower(), np.uint8).astype(np.uint32)
                mixed = ((b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) + np.uint32(1)) * np.uint32(0x9E3779B1)
                got += np.bincount(mixed >> np.uint32(20), minlength=WIDTH + 1) * words[w]  # 12 bits: WIDTH
        total = int(times.sum())
        lines = text.split(b"\n")
        extra = [
            (b"length", int(math.log2(len(text) + 1) * 2)),
            (b"words", int(math.log2(total + 1) * 2)),
            (b"distinct", int(10 * len(words) / total) if total else 0),
            (b"lines", int(math.log2(len(lines)) * 2)),
            (b"same", int(10 * len(set(lines)) / len(lines))),
            (b"line", int(math.log2(len(text) / len(lines) + 1) * 2)),
            (b"mean", int(2 * len(text) / total) if total < 1 or len(text) / total < 20 else 40) if total else (b"mean", -1),
            (b"top", int(10 * times.max() / total) if total else 0),
        ]
        for kind, value in extra:
            got[self._slot(kind, b"%d" % value)] += max(1, int(math.sqrt(total)))
        slots = np.flatnonzero(got[:WIDTH])
        return slots, got[slots]


class Model:
    """Latent directions and labelled vectors, of bounded size, sent to every worker."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray, vectors: np.ndarray, label: np.ndarray, share: np.ndarray, k: int, power: float):
        self.idf, self.axes, self.vectors, self.label, self.share, self.k, self.power = idf, axes, vectors, label, share, k, power
        total = share.sum()
        self.prior = float((share * label).sum() / total) if total else 0.0
        self.knots, self.values = np.zeros(1), np.full(1, self.prior)
        if len(label):
            votes = self._votes(vectors, leave=np.arange(len(label)))
            self.knots, self.values = rising(votes, label, share)

    def latent(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        out = np.zeros((len(counted), self.axes.shape[1]))
        for i, (slots, counts) in enumerate(counted):
            out[i] = ((1 + np.log(counts)) * self.idf[slots]) @ self.axes[slots]
        size = np.sqrt((out**2).sum(1, keepdims=True))
        return out / np.where(size > 0, size, 1)

    def _votes(self, x: np.ndarray, leave: np.ndarray | None = None, block: int = 512) -> np.ndarray:
        out = np.full(len(x), self.prior)
        k = min(self.k, len(self.label))
        for lo in range(0, len(x), block):
            cosine = x[lo : lo + block] @ self.vectors.T
            if leave is not None:
                cosine[np.arange(len(cosine)), leave[lo : lo + block]] = -2
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            c = np.take_along_axis(cosine, near, 1)
            w = np.maximum(c, 0) ** self.power * self.share[near]
            out[lo : lo + block] = ((w * self.label[near]).sum(1) + self.prior * 1e-3) / (w.sum(1) + 1e-3)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self._votes(x), self.knots, self.values), 0, 1) if len(self.label) else np.zeros(len(x))


def _count_documents(texts: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the feature)) + 1 over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, df, n = Features(), np.zeros(WIDTH + 1, np.int64), 0
        for batch in slices(batches, 0):
            for t in batch.column(0).to_pylist():
                df[features.count(t)[0]] += 1
                n += 1
        df[WIDTH] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(WIDTH + 1)), pa.array(df)], ["slot", "n"])

    df = np.zeros(WIDTH + 1)
    for r in texts.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        df[r["slot"]] = r["n"]
    return np.log((1 + df[WIDTH]) / (1 + df[:WIDTH])) + 1


def _axes(rows: np.ndarray, rank: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors by a randomised range finder with power steps."""
    rng = np.random.default_rng(seed)
    basis = rows.T @ (rows @ rng.standard_normal((rows.shape[1], min(rank + 16, *rows.shape))).astype(rows.dtype))
    for _ in range(3):
        basis = np.linalg.qr(basis)[0]
        basis = rows.T @ (rows @ basis)
    basis = np.linalg.qr(basis)[0]
    _, _, vt = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ vt.T)[:, :rank]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_per_label: int = 4000,
    rank: int = 64,
    k: int = 15,
    power: float = 4.0,
) -> Model:
    """Examples: the ``max_per_label`` labelled rows of each label with the smallest hash of their id, rows held
    out never; the latent space is that of these examples. Document frequencies are counted over all of ``docs``.
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

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, 1):
            got = [features.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([a for a, _ in got], pa.list_(pa.int64())), pa.array([b for _, b in got], pa.list_(pa.float64()))],
                ["id", "label", "slots", "counts"],
            )

    chosen = docs.select(F.col(id_col).alias("id"), raw(text_col).alias("text")).join(sample, "id").select("id", "text", "label")
    schema = schema_of(chosen, "id", "label int, slots array<long>, counts array<double>")
    # rows of at most WIDTH counts each
    got = materialise(chosen.mapInArrow(counts, schema), "quality-examples").orderBy("id").toArrow()
    counted = [
        (np.array(a, np.int64), np.array(b)) for a, b in zip(got.column("slots").to_pylist(), got.column("counts").to_pylist(), strict=True)
    ]
    label = got.column("label").to_numpy().astype(float)
    del got
    idf = _count_documents(docs.select(raw(text_col).alias("text")))
    if not len(label):
        return Model(idf, np.zeros((WIDTH, 1)), np.zeros((0, 1)), label, label, k, power)
    rows = np.zeros((len(counted), WIDTH), np.float32)
    for i, (slots, n) in enumerate(counted):
        row = (1 + np.log(n)) * idf[slots]
        size = math.sqrt((row**2).sum())
        rows[i, slots] = row / size if size else 0
    axes = _axes(rows, rank).astype(float)
    del rows
    share = np.array([totals[int(v)] / (label == v).sum() for v in label])
    blank = Model(idf, axes, np.zeros((0, axes.shape[1])), np.zeros(0), np.zeros(0), k, power)
    return Model(idf, axes, blank.latent(counted), label, share / share.min(), k, power)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score. Null counts as empty; empty texts are scored by their features
    like others; without labels every score is 0. Repeated rows score alike; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, 1):
            x = shared.value.latent([features.count(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x), pa.float64())], [id_col, "score"])

    return docs.select(F.col(id_col), raw(text_col).alias("__text")).mapInArrow(run, schema_of(docs, id_col, "score double"))
