"""From raw documents to token ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontam, pii, quality, simhash
from tidemark.llm.batches import kept
from tidemark.session import tune


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the policy rejects."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose fingerprints are linked, that with the smallest id."""
    return simhash.keep_representatives(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.drop_contaminated(docs, items)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and the digest of the text that they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, path, pattern), path, pattern)
    return decoded.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", good_quality),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmarks),
    ("PII", without_personal_data),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: Fingerprints and token ids have no SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents table of a folder."""
    docs = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
