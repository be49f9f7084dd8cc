"""From raw documents to tokens: each stage works on what the one before has kept.

The stages: toxic documents go; of exact copies one row stays; of every group of near copies one
document stays; documents with a benchmark passage go; what is left becomes tokens, whose decoding is
compared with the text. A stage keeps all columns of documents, the last returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import bpe, decontaminate, exact_dedup, ngram_join, toxicity
from stratalake.llm.common import table
from stratalake.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity is 0.3 or more; the examples are the labelled ones among ``docs``."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest doc_id of each group linked at a Jaccard similarity of 0.8 on five-word shingles."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold ten consecutive words of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of the public byte-level vocabulary."""
    import public_tokenizers as public

    # smaller memories than alone: the executors also hold what the earlier stages needed
    tokens = bpe.round_trip(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, max_words=100_000, max_states=60_000)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", to_tokens),
]

# toxicity is a fitted model and BPE has no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
