"""The training-data pipeline: documents through five stages, each written before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.byte_bpe import with_tokens
from wordloom.llm.decontamination import without_benchmark
from wordloom.llm.near_duplicates import without_near_duplicates
from wordloom.llm.quality import accepted
from wordloom.llm.suffix_dedup import with_repeats_cut
from wordloom.scratch import new_path

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Unless a contract says otherwise, near-duplicates share 0.8 of five-word shingles.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps: neither of low quality nor toxic."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    return without_near_duplicates(docs, SHINGLE, PERCENT)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that also start earlier."""
    return with_repeats_cut(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and the digest of what the ids decode to."""
    return with_tokens(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_bytes),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]

# The classifier is fitted on a sample, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
