"""The queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.backoff import backoff_scores
from wordloom.llm.byte_bpe import round_trip
from wordloom.llm.decontamination import contamination
from wordloom.llm.embedding_links import embedding_links
from wordloom.llm.fingerprints import fingerprint_documents
from wordloom.llm.near_duplicates import near_duplicates
from wordloom.llm.oracle import ORACLE
from wordloom.llm.pages import extract_main_text
from wordloom.llm.prefix_trie import prefix_trie
from wordloom.llm.quality import score
from wordloom.llm.substring_dedup import without_repeated_words
from wordloom.llm.suffix_dedup import without_repeated_bytes
from wordloom.llm.token_alignment import align_tokens
from wordloom.llm.token_counts import count_tokens

# The tokenizer files of the queries, as parameters.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_words(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("_id", "_h")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    ids = F.array_join("items", ",")
    return (
        contamination(docs, benchmark)
        .withColumn("items_sha256", F.sha2(F.encode(ids, "UTF-8"), 256))
        .drop("items")
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_documents(table(spark, sf_dir, "documents"))
    edited = F.sha2(F.encode("edited_text", "UTF-8"), 256)
    return found.withColumn("edited_sha256", edited).drop("edited_text")


def op11_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECE_MODEL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_katz_backoff": op4_katz_backoff,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_decontamination": op9_decontamination,
    "op10_fingerprints": op10_fingerprints,
    "op11_embedding_links": op11_embedding_links,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_alignment": op13_token_alignment,
}

__all__ = ["ORACLE", "QUERIES"]
