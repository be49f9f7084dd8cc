"""Language of pages by fusing evidence: text, declared markup language, address suffix, host.

Likelihoods of character trigrams come from a naive Bayes model of labelled documents. What pages
declare and the suffix of their host are weighed by how often each goes with each language, and
the prior of a host is drawn towards that of its domain, this towards its suffix, this towards all
pages. All of these are grouped sums of the text's own posteriors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import LOWER, UPPER, raw, schema_of, slices
from stratalake.llm.warc import BLANK, visible_text
from stratalake.session import materialise

SLOTS = 1 << 14
MARGIN = 12.0  # text evidence, in nats, counts as this at most: trigrams of a text are not independent


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased text, ASCII digits and marks as blanks."""
    b = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    b = np.where((b >= 0x80) | ((b >= 0x61) & (b <= 0x7A)), b, 0x20)
    if len(b) < 3:
        return np.zeros(SLOTS)
    h = (b[:-2] * np.uint32(0x9E3779B1) ^ b[1:-1] * np.uint32(0x85EBCA6B) ^ b[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    return np.bincount(h >> np.uint32(18), minlength=SLOTS).astype(float)


def fit_text(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", max_per_lang: int = 5000) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities of trigrams): naive Bayes on at most ``max_per_lang`` documents of each
    language, those with the smallest hash of their id. Only sums by language reach the driver."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col).cast("string")).alias("h")
    )
    langs = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    picked = None
    for v in langs:
        one = known.filter(F.col("lang") == v).orderBy("h", "id").limit(max_per_lang).select("id", F.col("lang").alias("as"))
        picked = one if picked is None else picked.unionByName(one)
    if picked is None:
        return [], np.zeros((0, SLOTS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {v: np.zeros(SLOTS) for v in langs}
        for batch in slices(batches, 0):
            for t, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[v] += trigrams(t)
        some = [v for v in langs if total[v].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([total[v] for v in some], pa.list_(pa.float64()))], ["lang", "n"])

    rows = (
        docs.select(F.col(id_col).alias("id"), raw(text_col).alias("text"))
        .join(F.broadcast(picked), "id")  # bounded: ids and languages of the sample
        .select("text", "as")
        .mapInArrow(count, "lang string, n array<double>")
        .select("lang", F.posexplode("n").alias("slot", "n"))
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    total = np.zeros((len(langs), SLOTS))
    total[[langs.index(v) for v in rows["lang"]], rows["slot"]] = rows["n"]
    return langs, np.log((total + 0.5) / (total + 0.5).sum(1, keepdims=True))


def declared_language(html: Column) -> Column:
    """Primary subtag of the lang attribute of the html element, lower case, or empty."""
    found = F.regexp_extract(html, f"(?i)<html(?:{BLANK}[^>]*)?{BLANK}lang=[\"']?([A-Za-z]+)", 1)
    return F.translate(found, UPPER, LOWER)


def _posterior(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)


def _sums(rows: DataFrame, by: str, k: int) -> DataFrame:
    sums = [F.sum(F.col("text_p")[i]).alias(f"s{i}") for i in range(k)]
    return rows.groupBy(by).agg(*sums).select(by, F.array(*[f"s{i}" for i in range(k)]).alias(f"of_{by}"))


def identify(
    pages: DataFrame, langs: list[str], logs: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    pull: float = 4.0, smooth: float = 1.0,
) -> DataFrame:
    """One row per row of ``pages``: id, lang, p, text_lang, declared, suffix, host, posterior (by language).

    A page's own share is taken out of the sums of its host, domain and suffix before they judge it. Null or
    empty pages have even text likelihoods and follow their host; null addresses share the empty host. Ties
    go to the language first in the alphabet. Without labelled documents lang is null.
    """
    k = len(langs)
    html, url = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (html_col, url_col))
    # credentials and port are no part of the name
    host = F.translate(F.regexp_extract(url, "(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1), UPPER, LOWER)
    parts = pages.select(F.col(id_col), host.alias("host"), declared_language(html).alias("declared"), visible_text(html).cast("binary").alias("__text"))
    if not k:
        return parts.select(
            id_col, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("p"), F.lit(None).cast("string").alias("text_lang"),
            "declared", F.element_at(F.split("host", "\\."), -1).alias("suffix"), "host", F.array().cast("array<double>").alias("posterior"),
        )
    shared = pages.sparkSession.sparkContext.broadcast(logs)

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            out = []
            for t in batch.column(3).to_pylist():
                score = shared.value @ trigrams(t or b"")
                out.append(np.maximum(score - score.max(), -MARGIN))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out, pa.list_(pa.float64()))], [id_col, "host", "declared", "text_l"]
            )

    rows = parts.mapInArrow(likelihoods, schema_of(pages, id_col, "host string, declared string, text_l array<double>"))
    labels = F.split("host", "\\.")
    rows = materialise(
        rows.withColumn("text_p", _posterior(F.col("text_l")))
        .withColumn("suffix", F.element_at(labels, -1))
        .withColumn("domain", F.when(F.size(labels) > 2, F.concat_ws(".", F.slice(labels, -2, 2))).otherwise(F.col("host"))),
        "likelihoods",
    )
    whole = rows.agg(*[F.sum(F.col("text_p")[i]).alias(f"s{i}") for i in range(k)]).first()
    overall = np.array([x or 0.0 for x in whole]) + smooth
    prior = F.array(*[F.lit(float(x)) for x in overall / overall.sum()])
    for by in ("declared", "suffix", "domain", "host"):
        rows = rows.join(_sums(rows, by, k), by)

    def without(c: str) -> Column:
        return F.zip_with(c, "text_p", lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def drawn(counts: Column, towards: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, towards, lambda c, t: (c + pull * t) / (n + pull))

    def evidence(c: str) -> Column:
        """ln P(value | language) up to a constant of the page."""
        return F.transform(
            F.arrays_zip(without(c).alias("c"), prior.alias("t")),
            lambda x: F.log((x["c"] + smooth * x["t"]) / x["t"]),
        )

    rows = (
        rows.withColumn("p_suffix", drawn(without("of_suffix"), prior))
        .withColumn("p_domain", drawn(without("of_domain"), F.col("p_suffix")))
        .withColumn("p_host", drawn(without("of_host"), F.col("p_domain")))
    )
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = add(F.col("text_l"), F.transform("p_host", lambda x: F.log(x + F.lit(1e-9))))
    fused = F.when(F.col("declared") != "", add(fused, evidence("of_declared"))).otherwise(fused)
    names = F.array(*[F.lit(v) for v in langs])
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return rows.withColumn("posterior", _posterior(fused)).select(
        id_col, best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("p"), best(F.col("text_p")).alias("text_lang"),
        "declared", "suffix", "host", "posterior",
    )
