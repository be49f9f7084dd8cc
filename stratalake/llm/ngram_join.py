"""Near duplicates by Jaccard similarity of word shingles.

Shingles are hashed into groups and a set becomes the point of its group counts: two sets share at
most the sum of the smaller of their counts, group by group. Points lie in R-trees whose boxes
bound that sum for all sets below, and surviving pairs are verified on the whole sets.

Trees are built where sets can meet: sets that reach the threshold have a shingle in common among
the first of each, in one order of all shingles, rarest groups first. Sets with such a shingle
form a bucket, cut into chunks of bounded size. A first round links every set to its nearest
points within a chunk. Components of the links are formed, and a second round searches, in all
buckets that still hold several components, the pairs between different components, so no link
that joins components is lost and no pair within a component is looked at again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.llm.common import in_batches, only, raw, schema_of, slices
from stratalake.llm.components import components
from stratalake.session import materialise

LEAST_BITS = 6  # of the number of a group: a point has 64 coordinates at least
SKETCH_BITS = 20  # groups whose totals order the shingles
CHUNK = 256
_P = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _P[1]
    h = (h ^ (h >> np.uint64(27))) * _P[2]
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes; keeps up to ``max_words`` word hashes."""

    def __init__(self, width: int = 5, max_words: int = 200_000):
        self.width, self.max_words, self.known = width, max_words, {}

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        known, hashed = self.known, xxhash.xxh64_intdigest
        if len(known) > self.max_words:
            known.clear()
        words = [t.lower().split() for t in texts]  # bytes: A-Z and ASCII white space only
        for ws in words:
            for w in set(ws).difference(known):
                known[w] = hashed(w)
        sizes = [len(ws) for ws in words]
        line = np.fromiter((known[w] for ws in words for w in ws), np.uint64, sum(sizes))
        rolled = np.zeros(max(len(line) - self.width + 1, 0), np.uint64)
        for k in range(self.width if len(rolled) else 0):
            rolled += line[k : k + len(rolled)] * _P[k % 5] + np.uint64(k)
            rolled = (rolled << np.uint64(7)) | (rolled >> np.uint64(57))
        rolled = _mix(rolled)
        out, at = [], 0
        for n in sizes:
            if n >= self.width:
                out.append(np.unique(rolled[at : at + n - self.width + 1]))
            elif n:  # the whole sequence is its one shingle
                out.append(np.array([xxhash.xxh64_intdigest(line[at : at + n].tobytes(), seed=n)], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
        return out


def set_number(s: np.ndarray) -> int:
    """Identity of a set of shingles: equal sets have one number."""
    return xxhash.xxh64_intdigest(s.tobytes(), seed=5) - (1 << 63)


def fineness(n: np.ndarray) -> np.ndarray:
    """Bits of a group number for sets of n: about eight shingles a group, 64 groups at least.

    With as few groups for long texts as for short ones, chance alone would fill the minima. Sets that can
    reach a similarity above one half differ by one at most.
    """
    return np.maximum(LEAST_BITS, np.ceil(np.log2(np.maximum(n, 1) / 8)).astype(np.int64))


def point(s: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Counts of shingles by group; halving the groups adds neighbours."""
    bits = int(fineness(np.array(len(s)))) if bits is None else bits
    return np.bincount(((s << np.uint64(20)) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def packed(p: np.ndarray) -> bytes:
    """One byte a count; two or four where a count needs them."""
    top = p.max(initial=0)
    return p.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def unpacked(data: list[bytes], bits: int) -> np.ndarray:
    if all(len(x) == 1 << bits for x in data):
        return np.frombuffer(b"".join(data), "u1").reshape(-1, 1 << bits).astype(np.int32)
    return np.array([np.frombuffer(x, {1: "u1", 2: "<u2", 4: "<u4"}[len(x) >> bits]) for x in data], np.int32)


def halved(points: np.ndarray) -> np.ndarray:
    return points.reshape(len(points), -1, 2).sum(2, dtype=np.int32)


def least_overlap(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray:
    """The smallest intersection of sets of a and b elements with Jaccard percent / 100."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """R-tree over points of group counts, packed bottom-up in order of set size and counts.

    A node keeps the largest count of each group and the smallest and largest set size below it.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fanout: int = 8):
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.fanout = fanout
        high, low_n, high_n = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(high, low_n, high_n)]
        while len(high) > fanout:
            cuts = np.arange(0, len(high), fanout)
            high, low_n, high_n = np.maximum.reduceat(high, cuts), np.minimum.reduceat(low_n, cuts), np.maximum.reduceat(high_n, cuts)
            self.levels.append((high, low_n, high_n))

    def reach(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, member, bound) where the summed minima allow the threshold."""
        top = self.levels[-1][0]
        q = np.repeat(np.arange(len(points)), len(top))
        node = np.tile(np.arange(len(top)), len(points))
        bound = np.zeros(0, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low_n, high_n = self.levels[depth]
            # sizes first: 100 * smaller >= percent * larger
            fit = (100 * high_n[node] >= percent * sizes[q]) & (100 * sizes[q] >= percent * low_n[node])
            q, node = q[fit], node[fit]
            bound, step = np.zeros(len(q), np.int64), max(64, (1 << 22) // points.shape[1])
            for lo in range(0, len(q), step):
                some = slice(lo, lo + step)
                bound[some] = np.minimum(points[q[some]], high[node[some]]).sum(1, dtype=np.int64)
            good = bound >= least_overlap(sizes[q], low_n[node], percent)
            q, node, bound = q[good], node[good], bound[good]
            if depth:
                below = len(self.levels[depth - 1][0])
                q = np.repeat(q, self.fanout)
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                q, node = q[node < below], node[node < below]
        return q, self.order[node], bound


def _sets_and_sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, set, print, point) of every document, and beside them slices of each task's group totals.

    ``print`` is a fingerprint of the text, by which it is found again whatever its id.
    """
    step = 1 << 14
    names = [id_col, "n", "set", "print", "point", "slice", "totals"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, totals, id_type = Shingler(), np.zeros(1 << SKETCH_BITS, np.uint32), None
        for batch in slices(batches, 1):
            sets = shingler.sets(batch.column(1).to_pylist())
            id_type = batch.column(0).type
            if sets:
                totals += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(totals)).astype(np.uint32)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_number(s) if len(s) else None for s in sets], pa.int64()),
                    batch.column(2),
                    pa.array([packed(point(s)) if len(s) else None for s in sets], pa.binary()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names,
            )
        if id_type is not None:
            parts = [(i // step, totals[i : i + step].astype("<u4").tobytes()) for i in range(0, len(totals), step)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, id_type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array([i for i, _ in parts], pa.int32()), pa.array([t for _, t in parts], pa.binary())],
                names,
            )

    schema = schema_of(docs, id_col, "n long, set long, print long, point binary, slice int, totals binary")
    text = raw(text_col)
    return in_batches(docs.select(id_col, text.alias("__text"), F.xxhash64(text).alias("__print")), run, schema)


def _totals(mixed: DataFrame) -> np.ndarray:
    """Group totals over all documents; as large as the sketch, whatever the input."""

    def add(key: tuple, part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<u4").astype(np.uint64) for x in part.column("totals").to_pylist())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "totals": pa.array([total.astype("<u8").tobytes()], pa.binary())})

    rows = mixed.filter("slice is not null").select("slice", "totals").groupBy("slice").applyInArrow(add, "slice int, totals binary").collect()
    parts = [np.frombuffer(r["totals"], "<u8") for r in sorted(rows, key=lambda r: r["slice"])]
    return np.concatenate(parts) if parts else np.zeros(1 << SKETCH_BITS, np.uint64)


def _buckets(docs: DataFrame, text_col: str, totals: np.ndarray, n_shingles: int, percent: int, hot: int) -> DataFrame:
    """(bucket, sets, by_size, by_hash, set) of all buckets with more than one set; equal buckets once per block.

    ``by_size`` and ``by_hash`` are the set's chunks when a bucket is cut in order of size or at random.

    A task packs the first shingles of its sets into one row per block of hashes, so the shuffle moves few
    rows. Shingles of groups that stand out by more than ``hot`` sets are dealt to several blocks; their
    bucket is named by the shingle, and the second round joins its parts.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = n_shingles * (100 - percent) // 100
    blocks = max(4 * partitions, first >> 20)
    shared = spark.sparkContext.broadcast(totals)
    usual = float(totals.mean())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen, totals = Shingler(), set(), shared.value
        parts_of = np.maximum(1, np.ceil((totals - 1.5 * usual) / hot)).astype(np.uint64)
        held: list[tuple[np.ndarray, int, int]] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key = np.concatenate([k for k, _, _ in held])
            sizes = [len(k) for k, _, _ in held]
            number = np.repeat(np.array([s for _, s, _ in held], np.int64), sizes)
            n = np.repeat(np.array([n for _, _, n in held], np.int64), sizes)
            parts = parts_of[(key >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            part = np.where(parts > 1, _mix(number.view(np.uint64)) % parts + np.uint64(1), np.uint64(0))
            block = (_mix(key + part * _P[3]) % np.uint64(blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1, append=blocks))
            rows, names, counts = [], [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                some = order[a:b]
                many = part[some].astype("<u4").tobytes() if part[some].any() else b""
                rows.append(key[some].astype("<u8").tobytes() + number[some].astype("<i8").tobytes() + n[some].astype("<u4").tobytes() + many)
                counts.append(len(some))
                names.append(int(block[some[0]]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(counts, pa.int32()), pa.array(rows, pa.binary())], ["block", "m", "entries"])

        for batch in slices(batches, 0):
            for s in shingler.sets(batch.column(0).to_pylist()):
                if not len(s) or (number := set_number(s)) in seen:
                    continue
                seen.add(number)
                k = len(s) - int(-(-percent * len(s) // 100)) + 1
                rank = np.lexsort((s, totals[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                held.append((s[rank[:k]], number, len(s)))
                count += k
            if count > 1 << 20:
                yield from flush()
                held.clear()
                count = 0
        if held:
            yield from flush()

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        keys, numbers, ns, parts = [], [], [], []
        for m, x in zip(rows.column("m").to_pylist(), rows.column("entries").to_pylist(), strict=True):
            keys.append(np.frombuffer(x, "<u8", m))
            numbers.append(np.frombuffer(x, "<i8", m, 8 * m))
            ns.append(np.frombuffer(x, "<u4", m, 16 * m))
            parts.append(np.frombuffer(x, "<u4", m, 20 * m) if len(x) > 20 * m else np.zeros(m, np.uint32))
        k, s, n, p = np.concatenate(keys), np.concatenate(numbers), np.concatenate(ns), np.concatenate(parts)
        order = np.lexsort((s, n, p, k))
        k, s, n, p = k[order], s[order], n[order], p[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1])]  # a set comes once from each task
        k, s, p = k[new], s[new], p[new]
        start = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
        stop = np.r_[start[1:], len(k)]
        seen, bucket, size, by_size, by_hash, member = set(), [], [], [], [], []
        for a, b in zip(start.tolist(), stop.tolist(), strict=True):
            if b - a == 1 and not p[a]:
                continue
            if p[a]:  # a part of a hot shingle
                name, base = int(k[a].astype(np.int64)), int(p[a]) << 24
            else:
                name, base = xxhash.xxh64_intdigest(s[a:b].tobytes()) - (1 << 63), 0
                if name in seen:
                    continue
                seen.add(name)
            pieces = -(-(b - a) // CHUNK)
            bucket.append(np.full(b - a, name, np.int64))
            size.append(np.full(b - a, b - a, np.int64))
            by_size.append(base + np.arange(b - a) // CHUNK)
            random = _mix(s[a:b].view(np.uint64) ^ np.uint64(name & ((1 << 64) - 1)))
            by_hash.append(base + (random % np.uint64(pieces)).astype(np.int64))
            member.append(s[a:b])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        columns = {"bucket": bucket, "sets": size, "by_size": by_size, "by_hash": by_hash, "set": member}
        return pa.table({c: pa.array(join(x), pa.int64()) for c, x in columns.items()})

    packed = in_batches(docs.select(raw(text_col).alias("__text")), pack, "block long, m int, entries binary")
    return packed.groupBy("block").applyInArrow(meet, "bucket long, sets long, by_size long, by_hash long, set long").distinct()


def _whole_sets(docs: DataFrame, text_col: str, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, shingles) of the wanted sets, made again from one text each, found by its fingerprint."""
    one = members.join(wanted, "set", "left_semi").groupBy("set").agg(F.min("print").alias("__print")).select("__print").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, seen = Shingler(), set()
        for batch in slices(batches, 0):
            texts = {xxhash.xxh128_digest(t): t for t in batch.column(0).to_pylist()}  # copies once
            new = [t for d, t in texts.items() if d not in seen]
            seen.update(texts)
            sets = [s for s in shingler.sets(new) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_number(s) for s in sets], pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                ["set", "shingles"],
            )

    text = raw(text_col)
    texts = docs.select(F.xxhash64(text).alias("__print"), text.alias("__text"))
    texts = only(texts, materialise(one, "texts"), "__print").select("__text")
    # a text that several tasks have brings its set several times, two texts of one print may bring a set that nobody wants
    return in_batches(texts, run, "set long, shingles binary").dropDuplicates(["set"])


def _search(rows: DataFrame, percent: int, per_task: int = 40_000) -> DataFrame:
    """Pairs (a, b) that may reach the threshold, from rows (cell, side, set, n, point) of bounded cells.

    Sides 0 and 1 of a cell are searched against each other, a side 2 against itself. Each set gets its
    nearest point. Rows with (comp, bucket, buckets) too give every pair of different components, in the
    first of the buckets that both sets are in, so that a pair comes once however much its sets share.
    """
    whole = "comp" in rows.columns

    n_rows = rows.count()
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4, n_rows // per_task)

    def reach(left: dict, right: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of both that may reach the threshold, with the bound: one tree for each fineness in use."""
        for bits in np.unique(right["bits"]).tolist():
            there = np.flatnonzero(right["bits"] == bits)
            points = unpacked([right["point"][i] for i in there], bits)
            for other in (bits - 1, bits, bits + 1):
                here = np.flatnonzero(left["bits"] == other)
                if not len(here):
                    continue
                asked = unpacked([left["point"][i] for i in here], other)
                asked = halved(asked) if other > bits else asked
                tree = CountTree(halved(points) if other < bits else points, right["n"][there])
                q, m, bound = tree.reach(asked, left["n"][here], percent)
                yield here[q], there[m], bound

    def met_before(left: dict, right: dict, q: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether the pairs share a bucket of a smaller name than that of the cell."""
        here = left["bucket"][0]
        earlier = [[[b for b in x if b < here] for x in part["buckets"]] for part in (left, right)]
        names = {b: k for k, b in enumerate(sorted({b for part in earlier for x in part for b in x}))}
        if not names:
            return np.zeros(len(q), bool)
        marks = [np.zeros((len(part), len(names)), bool) for part in earlier]
        for mark, part in zip(marks, earlier, strict=True):
            for i, x in enumerate(part):
                mark[i, [names[b] for b in x]] = True
        out, step = np.zeros(len(q), bool), max(1, (1 << 24) // len(names))
        for lo in range(0, len(q), step):
            some = slice(lo, lo + step)
            out[some] = (marks[0][q[some]] & marks[1][m[some]]).any(1)
        return out

    def one(left: dict, right: dict, itself: bool) -> tuple[np.ndarray, np.ndarray]:
        q, m, bound = (np.concatenate(x) for x in zip(*reach(left, right), (np.zeros(0, np.int64),) * 3, strict=True))
        a, b = left["set"][q], right["set"][m]
        if whole:
            ok = (a < b if itself else a != b) & (left["comp"][q] != right["comp"][m])
            q, m, a, b = q[ok], m[ok], a[ok], b[ok]
            ok = ~met_before(left, right, q, m)
            return a[ok], b[ok]
        both = (bound + 1) / (left["n"][q] + right["n"][m] - bound + 1)
        ok = a != b
        q, a, b, both = q[ok], a[ok], b[ok], both[ok]
        order = np.lexsort((b, -both, q))
        q, a, b = q[order], a[order], b[order]
        nearest = np.r_[True, q[1:] != q[:-1]] if len(q) else np.zeros(0, bool)
        return a[nearest], b[nearest]

    def run(key: tuple, part: pa.Table) -> pa.Table:
        cell = part.column("cell").to_numpy()
        side = part.column("side").to_numpy()
        order = np.lexsort((side, cell))
        cell, side = cell[order], side[order]
        number, n = part.column("set").to_numpy()[order], part.column("n").to_numpy()[order]
        if whole:
            comp, bucket = part.column("comp").to_numpy()[order], part.column("bucket").to_numpy()[order]
            lists = part.column("buckets").to_pylist()
            lists = [lists[i] for i in order.tolist()]
        held = part.column("point").to_pylist()
        points, bits = [held[i] for i in order.tolist()], fineness(n)
        cuts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
        one_side, other = [], []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mid = lo + int(np.searchsorted(side[lo:hi], 1))
            pick = lambda i, j: {"set": number[i:j], "n": n[i:j], "bits": bits[i:j], "point": points[i:j]} | (
                {"comp": comp[i:j], "bucket": bucket[i:j], "buckets": lists[i:j]} if whole else {}
            )
            if side[lo] == 2:
                a, b = one(pick(lo, hi), pick(lo, hi), True)
            elif lo < mid < hi:
                a, b = one(pick(lo, mid), pick(mid, hi), False)
            else:
                continue
            one_side.append(np.minimum(a, b))
            other.append(np.maximum(a, b))
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        pairs = np.unique(np.stack([join(one_side), join(other)], 1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("cell"), F.lit(tasks)))
    return dealt.groupBy("deal").applyInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): the intersection of both whole sets is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            linked = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _first_cells(live: DataFrame) -> DataFrame:
    """Cells of the first round: the chunks of each set in its largest buckets, by size and at random.

    Copies of one text have their largest buckets in common, and chunks cut in several ways join up; whatever
    stays apart is left to the second round.
    """
    order = W.partitionBy("set").orderBy(F.desc("sets"), "bucket", "by_size")
    ranked = live.withColumn("k", F.row_number().over(order)).filter("k <= 3")
    both = F.array(F.struct(F.lit(0).alias("way"), F.col("by_size").alias("chunk")), F.struct(F.lit(1).alias("way"), F.col("by_hash").alias("chunk")))
    cut = ranked.select("bucket", "set", F.explode(F.when(F.col("sets") > CHUNK, both).otherwise(F.slice(both, 1, 1))).alias("c"))
    return cut.select(
        F.xxhash64("bucket", "c.way", "c.chunk").alias("cell"), F.lit(2).alias("side"), "set"
    )


def _cells(live: DataFrame, labels: DataFrame, limit: int = 1024) -> DataFrame:
    """Cells (cell, side, bucket, set, comp) for the pairs of different components within buckets.

    A component with more than ``limit`` sets of a bucket has chunks of its own there, the small ones share
    chunks; a cell is a pair of chunks that is not of one component, so the cells of a bucket with one huge
    component number as its chunks.
    """
    rows = live.select("bucket", "set").distinct().join(labels, live["set"] == labels["node"], "left")
    rows = materialise(rows.select("bucket", "set", F.coalesce("component", "set").alias("comp")), "labelled")
    mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("sets")).filter("lo < hi")
    mixed = materialise(mixed, "mixed")
    rows = rows.join(mixed.select("bucket", "sets"), "bucket")
    small = F.col("sets") <= limit
    alone = rows.filter(small).select(F.col("bucket").alias("cell"), F.lit(2).alias("side"), "bucket", "set", "comp")
    if mixed.filter(~small).isEmpty():
        return alone
    large = rows.filter(~small)
    per = large.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("own"))
    rest = per.filter(F.col("own") <= limit).groupBy("bucket").agg(F.sum("own").alias("rest"))
    dealt = materialise(
        large.join(per, ["bucket", "comp"]).join(rest, "bucket", "left").select(
            "bucket", "set", "comp",
            F.when(F.col("own") > limit, F.col("comp")).alias("owner"),
            F.when(F.col("own") > limit, F.pmod(F.xxhash64("set"), F.ceil(F.col("own") / limit)))
            .otherwise(F.pmod(F.xxhash64("set"), F.ceil(F.col("rest") / limit))).alias("piece"),
        ),
        "dealt",
    )
    chunks = dealt.select("bucket", "owner", "piece").distinct().withColumn("c", F.xxhash64("owner", "piece"))
    x, y = chunks.alias("x"), chunks.alias("y")
    pairs = x.join(y, F.col("x.bucket") == F.col("y.bucket")).filter(
        (F.col("x.c") <= F.col("y.c")) & ~F.coalesce(F.col("x.owner") == F.col("y.owner"), F.lit(False))
    )
    pairs = pairs.select(
        F.col("x.bucket").alias("bucket"), F.col("x.c").alias("c0"), F.col("y.c").alias("c1"),
        F.xxhash64("x.bucket", "x.c", "y.c").alias("cell"),
    )
    ends = pairs.select("bucket", "cell", F.explode(F.when(F.col("c0") == F.col("c1"), F.array(F.struct(F.lit(2).alias("side"), F.col("c0").alias("c")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("c0").alias("c")), F.struct(F.lit(1).alias("side"), F.col("c1").alias("c")))
    )).alias("end")).select("bucket", "cell", "end.side", "end.c")
    many = dealt.withColumn("c", F.xxhash64("owner", "piece")).join(ends, ["bucket", "c"]).select("cell", "side", "bucket", "set", "comp")
    return alone.unionByName(many)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, hot: int = 1 << 18
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable by links).

    Two texts link when percent of the union of their sets of five-word shingles is common to both; a text of
    fewer words is one shingle. Null and empty texts, and texts of white space, have no shingles, link with
    nothing and are their own component. Rows with equal sets are one set from the first shuffle on. Other
    columns are not read; a row without an id gets the smallest id of its component, or null.
    """
    comp, alone = _components_of(docs, id_col, text_col, percent, hot)
    least = comp.groupBy("comp").agg(F.min(id_col).alias("component_id"))
    return (
        comp.join(least, "comp")
        .select(id_col, F.col("n").alias("n_shingles"), "component_id")
        .union(alone.select(id_col, "n", F.col(id_col)))
    )


def _components_of(docs: DataFrame, id_col: str, text_col: str, percent: int = 80, hot: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """(id, n, comp) of the rows with shingles, written, and (id, n) of those without any."""
    mixed = materialise(_sets_and_sketch(docs, id_col, text_col), "sets")
    members = mixed.filter("slice is null").select(id_col, "n", "set", "print")
    size = members.agg(F.sum("n")).first()[0] or 0
    live = materialise(_buckets(docs, text_col, _totals(mixed), size, percent, hot), "live")
    points = mixed.filter("set is not null").select("set", "n", "point")
    points = materialise(points.join(live.select("set").distinct(), "set", "left_semi").dropDuplicates(["set"]), "points")

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "wanted")
        sets = materialise(_whole_sets(docs, text_col, members, wanted), "whole")
        return materialise(_verified(pairs, sets, percent), label)

    first = materialise(_first_cells(live), "cells")
    tested = verified(materialise(_search(first.join(points, "set"), percent), "near"), "tested")
    labels = materialise(components(tested.filter("linked")), "labels")
    cells = materialise(_cells(live, labels), "cells")
    lists = cells.select("set", "bucket").distinct().groupBy("set").agg(F.collect_list("bucket").alias("buckets"))
    more = _search(cells.join(points, "set").join(lists, "set"), percent)
    more = materialise(more.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "more")
    if not more.isEmpty():
        late = verified(more, "late").filter("linked")
        if not late.isEmpty():
            links = tested.filter("linked").select("a", "b").union(late.select("a", "b"))
            labels = materialise(components(links), "labels")
    comp = members.filter("set is not null").join(labels, members["set"] == labels["node"], "left").select(
        id_col, "n", F.coalesce("component", "set").alias("comp")
    )
    return materialise(comp, "comp"), members.filter("set is null").select(id_col, "n")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, hot: int = 1 << 18, small: int = 1_000_000
) -> DataFrame:
    """One row of each component of near copies, all columns kept: that of the smallest id.

    Rows are told apart by a number written once, so ids may repeat or be null: null ids come last, and of
    rows with one id the first written stays. Texts without shingles all stay. Up to ``small`` numbers of rows
    that go, which are counted, are broadcast and the rows stay where they are; more are joined by a shuffle.
    """
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("__row").alias("row"))
    comp, _ = _components_of(rows.withColumn("__key", key), "__key", text_col, percent, hot)
    best = comp.groupBy("comp").agg(F.min("__key").alias("best"))
    gone = comp.join(best, "comp").filter(F.col("__key.row") != F.col("best.row")).select(F.col("__key.row").alias("__row"))
    gone = materialise(gone, "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= small else gone, "__row", "left_anti").select(docs.columns)
