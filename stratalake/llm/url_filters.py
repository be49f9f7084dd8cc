"""URL rules in a sorted array of digests.

Rules are strings ``host/path``. Their 64-bit xxhash keys lie sorted in a file that every worker
maps into memory; a batch of addresses is probed by one binary search over all the strings that
could be its rules, and stored strings confirm each match, so colliding keys do no harm.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import LOWER, UPPER, schema_of
from stratalake.session import scratch_path

HEAD = struct.Struct("<4sqqq")  # magic, rules, bytes of strings, distinct path lengths


def pack(rules: Sequence[tuple[str, str]]) -> bytes:
    """The file of ``(action, host/path)`` rules; of rules with the same string the last one counts."""
    last = {text: action for action, text in rules}
    digests = sorted((xxhash.xxh64_intdigest(t.encode()), t.encode(), a == "allow") for t, a in last.items())
    texts = [t for _, t, _ in digests]
    lengths = sorted({len(t.partition("/")[2]) + 1 if "/" in t else 0 for t in last})
    out = io.BytesIO()
    blob = b"".join(texts)
    out.write(HEAD.pack(b"URLS", len(texts), len(blob), len(lengths)))
    out.write(np.array([d for d, _, _ in digests], "<u8").tobytes())
    out.write(np.cumsum([0, *map(len, texts)]).astype("<i8").tobytes())
    out.write(np.array(lengths, "<i8").tobytes())
    out.write(np.array([a for _, _, a in digests], np.uint8).tobytes())
    out.write(blob)
    return out.getvalue()


class DigestArray:
    """A packed file, mapped into memory."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        _, n, blob, k = HEAD.unpack(bytes(data[: HEAD.size]))
        at = HEAD.size

        def part(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(dtype).itemsize * count
            got = data[at : at + size].view(dtype)
            at += size
            return got

        self.keys, self.offset, lengths, self.allow = part("<u8", n), part("<i8", n + 1), part("<i8", k), part("u1", n)
        self.text = part("u1", blob)
        self.lengths = lengths.tolist()

    def probe(self, strings: list[str]) -> np.ndarray:
        """The rule of each string, -1 where there is none."""
        raw = [s.encode() for s in strings]
        digests = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
        at = np.searchsorted(self.keys, digests)
        found = np.full(len(raw), -1, np.int64)
        maybe = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, max(len(self.keys) - 1, 0))] == digests)) if len(self.keys) else []
        for i in maybe:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:  # equal keys lie together
                if bytes(self.text[self.offset[k] : self.offset[k + 1]]) == raw[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, verdict) of each address: of all rules that fit, the longest; of equally long ones that
        with the longer host."""
        strings, owner = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            suffixes = [host] if host else []
            dot = host.find(".")
            while dot >= 0:
                if dot + 1 < len(host):
                    suffixes.append(host[dot + 1 :])
                dot = host.find(".", dot + 1)
            for s in suffixes:
                for n in self.lengths:
                    if n <= len(path):
                        strings.append(s + path[:n])
                        owner.append((i, n + len(s), len(s)))
        best: dict[int, tuple[int, int, int]] = {}
        for (i, n, h), k in zip(owner, self.probe(strings).tolist(), strict=True):
            if k >= 0 and (n, h) > best.get(i, (-1, -1, -1))[:2]:
                best[i] = (n, h, k)
        out: list[tuple[str | None, str | None]] = []
        for i in range(len(hosts)):
            if i in best:
                k = best[i][2]
                out.append((bytes(self.text[self.offset[k] : self.offset[k + 1]]).decode(), "allow" if self.allow[k] else "block"))
            else:
                out.append((None, None))
        return out


def publish(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> str:
    """Write the packed rules to the shared folder and hand them to the executors; returns the file's name."""
    folder, name = scratch_path(spark, "url-rules"), f"rules-{uuid.uuid4().hex}.bin"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    data = pack(rules)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict.

    Host and path are empty for a null address or one without ``://``; the host keeps a port or user as
    written. A rule fits its host and all subdomains where the path starts with the rule's path. Where no
    rule fits, rule is null and the verdict is ``default``: an array of digests knows listed strings only.
    Repeated rows are judged alike, other columns are not read.
    """
    name = publish(pages.sparkSession, rules)
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    cut = "(?s)^.*?://([^/?#]*)([^?#]*)"
    parts = pages.select(
        F.col(id_col),
        F.translate(F.regexp_extract(url, cut, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, cut, 2).alias("path"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            got = array.judge(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([r for r, _ in got], pa.string()), pa.array([v or default for _, v in got], pa.string())],
                [id_col, "host", "path", "rule", "verdict"],
            )

    return parts.mapInArrow(run, schema_of(pages, id_col, "host string, path string, rule string, verdict string"))
