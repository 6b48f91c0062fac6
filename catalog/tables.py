"""The test tables in the roles the operators expect, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom import schemas
from wordloom.sources import read_table

# Set by the benchmark: its table of documents is one row group, so that a scan
# by itself keeps one core busy. Queries leave the rows where they are.
PARTITIONS: int | None = None

# The stop list and the search words of the queries.
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "that", "was", "for", "on"]
SEARCH_WORDS = ["le", "und", "que", "Le", "en", "le", "don't", "the"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text); ids are unique."""
    return read_table(spark, f"{sf_dir}/documents.parquet", schemas.DOCUMENTS, PARTITIONS)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) with several rows per id."""
    turns = table(spark, sf_dir, "conversations")
    return turns.select(F.col("conv_id").alias("doc_id"), "text")


def as_parents(df: DataFrame, entity_id: str, name: str, pos: str) -> DataFrame:
    return df.select(
        F.col(entity_id).alias("entity_id"), F.col(name).alias("name"), F.col(pos).alias("pos")
    )


def as_children(df: DataFrame, entity_id: str, label: str, pos: str) -> DataFrame:
    return df.select(
        F.col(entity_id).alias("entity_id"),
        F.col(label).cast("string").alias("label"),
        F.col(pos).alias("pos"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_parents(table(spark, sf_dir, "customer"), "c_custkey", "c_name", "c_custkey")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_children(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey")


def document_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_parents(table(spark, sf_dir, "documents"), "doc_id", "source", "doc_id")


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_children(table(spark, sf_dir, "labels"), "doc_id", "quality", "doc_id")


def sql_list(words: list[str]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


def sql_tokens(relation: str = "documents", doc_id: str = "doc_id") -> str:
    """A query for (doc_id, word) over the cleaned text."""
    return rf"""
        SELECT doc_id, word FROM (
            SELECT {doc_id} AS doc_id, unnest(string_split_regex(
                translate(lower(text), '-,."', ' '), '[ \t\n\r\f]+')) AS word
            FROM {relation})
        WHERE word <> ''"""


def sql_kept(relation: str = "documents", doc_id: str = "doc_id") -> str:
    return f"""
        SELECT doc_id, word FROM ({sql_tokens(relation, doc_id)})
        WHERE word NOT IN ({sql_list(STOP_WORDS)})"""


def sql_postings(relation: str = "documents", doc_id: str = "doc_id") -> str:
    return f"""
        SELECT word, doc_id, count(*) AS occurrences
        FROM ({sql_kept(relation, doc_id)}) GROUP BY word, doc_id"""
