"""Tokens, counts and postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (
    STOP_WORDS,
    conversations,
    documents,
    sql_kept,
    sql_postings,
    sql_tokens,
    table,
)
from wordloom.functions import posting_value, surrogate_key
from wordloom.operators import (
    corpus_total,
    drop_stop_words,
    last_posting_per_word,
    last_per_key,
    rank_terms,
    raw_postings,
    term_counts,
    tokens,
)
from wordloom.plans import build_index, corpus_tokens
from wordloom.sources import stop_words_from_lines


def kept(spark, sf_dir):
    return corpus_tokens(documents(spark, sf_dir), STOP_WORDS)


def index(spark, sf_dir):
    return build_index(documents(spark, sf_dir), STOP_WORDS, unique_ids=True)


def tokens_kept_long_list(spark, sf_dir):
    """The stop list is every word of the benchmark texts."""
    lines = table(spark, sf_dir, "benchmark").select(F.col("text").alias("value"))
    return drop_stop_words(
        tokens(documents(spark, sf_dir)), stop_words_from_lines(lines, "tokens")
    )


def document_lines(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select(F.explode(F.split("text", "\n")).alias("value"))


QUERIES = {
    "tokens_clean": lambda s, d: tokens(documents(s, d)),
    "tokens_kept": kept,
    "tokens_kept_long_list": tokens_kept_long_list,
    "corpus_total_terms": lambda s, d: corpus_total(kept(s, d)),
    "term_counts": lambda s, d: term_counts(kept(s, d)),
    "term_counts_ranked": lambda s, d: rank_terms(term_counts(kept(s, d))),
    "postings": index,
    "postings_grouped": lambda s, d: build_index(documents(s, d), STOP_WORDS),
    "postings_conversations": lambda s, d: build_index(conversations(s, d), STOP_WORDS),
    "postings_conversations_rows": lambda s, d: build_index(
        conversations(s, d), STOP_WORDS, unique_ids=True
    ),
    "raw_postings": lambda s, d: raw_postings(corpus_tokens(conversations(s, d), STOP_WORDS)),
    "posting_text": lambda s, d: index(s, d).select(
        "word", posting_value(F.col("doc_id"), F.col("occurrences")).alias("posting")
    ),
    "posting_surrogate_key": lambda s, d: index(s, d).select(
        surrogate_key(F.col("word"), F.col("doc_id")).alias("id"), "word", "doc_id", "occurrences"
    ),
    "last_posting_per_word": lambda s, d: last_posting_per_word(index(s, d)),
    "last_row_per_key": lambda s, d: last_per_key(
        table(s, d, "conversations"), ["conv_id"], ["turn"]
    ),
    "stop_words_tokens": lambda s, d: stop_words_from_lines(document_lines(s, d), "tokens"),
    "stop_words_lines": lambda s, d: stop_words_from_lines(document_lines(s, d), "lines"),
}

SQL_COUNTS = f"SELECT word, count(*) AS occurrences FROM ({sql_kept()}) GROUP BY word"
SQL_LINES = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"

ORACLE = {
    "tokens_clean": sql_tokens(),
    "tokens_kept": sql_kept(),
    "tokens_kept_long_list": rf"""
        SELECT doc_id, word FROM ({sql_tokens()}) t
        WHERE NOT EXISTS (
            SELECT 1 FROM (
                SELECT DISTINCT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word
                FROM benchmark) s
            WHERE s.word = t.word)""",
    "corpus_total_terms": f"SELECT count(*) AS occurrences FROM ({sql_kept()})",
    "term_counts": SQL_COUNTS,
    "term_counts_ranked": f"{SQL_COUNTS} ORDER BY occurrences DESC, word",
    "postings": sql_postings(),
    "postings_grouped": sql_postings(),
    "postings_conversations": sql_postings("conversations", "conv_id"),
    "postings_conversations_rows": sql_postings("conversations", "conv_id"),
    "raw_postings": f"""
        SELECT word, doc_id, CAST(1 AS BIGINT) AS occurrences
        FROM ({sql_kept("conversations", "conv_id")})""",
    "posting_text": f"""
        SELECT word, concat(doc_id, ' ', occurrences) AS posting FROM ({sql_postings()})""",
    "posting_surrogate_key": f"""
        SELECT concat(word, doc_id) AS id, word, doc_id, occurrences FROM ({sql_postings()})""",
    "last_posting_per_word": f"""
        SELECT word, doc_id, occurrences FROM (
            SELECT *, row_number() OVER (
                PARTITION BY word ORDER BY CAST(doc_id AS VARCHAR) DESC) AS n
            FROM ({sql_postings()}))
        WHERE n = 1""",
    "last_row_per_key": """
        SELECT conv_id, turn, role, text FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n
            FROM conversations)
        WHERE n = 1""",
    "stop_words_tokens": rf"""
        SELECT DISTINCT word FROM (
            SELECT unnest(string_split_regex(value, '[ \t\n\r\f]+')) AS word FROM ({SQL_LINES}))
        WHERE word <> ''""",
    "stop_words_lines": f"SELECT DISTINCT value AS word FROM ({SQL_LINES})",
}
