"""Corpus totals and term counts over (doc_id, word) tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_total(toks: DataFrame) -> DataFrame:
    """One row, also for an empty corpus."""
    return toks.agg(F.count("*").alias("occurrences"))


def term_counts(toks: DataFrame) -> DataFrame:
    return toks.groupBy("word").agg(F.count("*").alias("occurrences"))


def rank_terms(counts: DataFrame) -> DataFrame:
    """All words, most frequent first; equal counts in word order.

    The sort key is unique, so range partitioning can cut even within one count.
    """
    return counts.orderBy(F.desc("occurrences"), F.asc("word"))
