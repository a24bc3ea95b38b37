"""From raw documents to token ids: five stages, each on all that the one before has kept.

Every stage is written as Parquet in the shared folder and read again, so a lost executor costs
at most the stage that runs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline import scratch
from siltline.llm import bpe, decontaminate, quality_rules, secrets, simhash

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; n_chars counts what the text has then."""
    return secrets.redact(docs, sliding=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens) with the digest of the bytes that the ids decode to."""
    path = public_tokenizers.path(VOCABULARY)
    docs = docs.select("doc_id", "text")
    found = bpe.encode(docs, "text", path, public_tokenizers.PATTERN, "token_ids", "decoded")
    return found.select(
        "doc_id",
        "token_ids",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secret_scan),
    ("byte_bpe", tokens),
]

# Jensen-Shannon references, SimHash components and BPE cannot be put into SQL together; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch.new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
