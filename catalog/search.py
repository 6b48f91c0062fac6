"""Batch search over documents and over conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.lists import LABELS, SOURCES, TURNS, sql_lists
from catalog.tables import (
    SEARCH_WORDS,
    STOP_WORDS,
    as_children,
    as_parents,
    conversations,
    document_labels,
    document_sources,
    documents,
    sql_list,
    sql_postings,
    table,
)
from wordloom.functions import children_text
from wordloom.plans import build_index, search_documents, search_word
from wordloom.sources import query_words

ONE_WORD = "que"
PART_SIZE = 2

# Query ids of the benchmark words: item times this, plus the place of the word.
QIDS_PER_ITEM = 1_000_000


def answers(found):
    return found.withColumn("children", children_text(F.col("children")))


def search_top10(spark, sf_dir, **options):
    found = search_documents(
        documents(spark, sf_dir),
        document_sources(spark, sf_dir),
        document_labels(spark, sf_dir),
        query_words(spark, SEARCH_WORDS),
        STOP_WORDS,
        **options,
    )
    return answers(found)


def search_top10_benchmark_words(spark, sf_dir):
    """Every word of every benchmark text is a query, as typed."""
    words = table(spark, sf_dir, "benchmark").select(
        "item_id", F.posexplode(F.split("text", " ")).alias("i", "word")
    )
    found = search_documents(
        documents(spark, sf_dir),
        document_sources(spark, sf_dir),
        document_labels(spark, sf_dir),
        words.select((F.col("item_id") * QIDS_PER_ITEM + F.col("i")).alias("qid"), "word"),
        STOP_WORDS,
    )
    return answers(found)


def _search_conversations(spark, sf_dir, **options):
    turns = table(spark, sf_dir, "conversations")
    found = search_documents(
        conversations(spark, sf_dir),
        as_parents(turns, "conv_id", "role", "turn"),
        as_children(turns, "conv_id", "role", "turn"),
        query_words(spark, SEARCH_WORDS),
        STOP_WORDS,
        **options,
    )
    return answers(found)


def search_one_word(spark, sf_dir):
    posts = build_index(documents(spark, sf_dir), STOP_WORDS)
    sides = document_sources(spark, sf_dir), document_labels(spark, sf_dir)
    return answers(search_word(posts, *sides, ONE_WORD))


QUERIES = {
    "search_one_word": search_one_word,
    "search_top10": search_top10,
    "search_top10_not_few": lambda s, d: search_top10(s, d, few=False),
    "search_top10_benchmark_words": search_top10_benchmark_words,
    "search_top10_conversations": _search_conversations,
    "search_top10_conversation_parts": lambda s, d: _search_conversations(
        s, d, part_length=PART_SIZE
    ),
}

SQL_WORDS = ", ".join(f"({i}, {sql_list([w])})" for i, w in enumerate(SEARCH_WORDS))
SQL_SEARCH_WORDS = f"""
    SELECT CAST(qid AS BIGINT) AS qid, word FROM (VALUES {SQL_WORDS}) v(qid, word)"""
SQL_BENCHMARK_WORDS = f"""
    SELECT item_id * {QIDS_PER_ITEM} + unnest(range(len(l))) AS qid, unnest(l) AS word
    FROM (SELECT item_id, string_split(text, ' ') AS l FROM benchmark)"""


def sql_search(words: str, postings: str, entities: str, k: int = 10) -> str:
    return f"""
        SELECT qid, q.word, CAST(rank AS INTEGER) AS rank, doc_id, occurrences,
               name, part, n_children, children
        FROM ({words}) q JOIN (
            SELECT *, row_number() OVER (
                PARTITION BY word ORDER BY occurrences DESC, doc_id) AS rank
            FROM ({postings}) p JOIN ({entities}) e ON entity_id = doc_id) t
        ON t.word = q.word
        WHERE rank <= {k}"""


SQL_DOCUMENT_ENTITIES = sql_lists(SOURCES, LABELS, " ")
SQL_CONVERSATIONS = sql_search(
    SQL_SEARCH_WORDS,
    sql_postings("conversations", "conv_id"),
    sql_lists(TURNS, TURNS, " "),
)

ORACLE = {
    "search_one_word": f"""
        SELECT word, doc_id, occurrences, name, part, children FROM ({sql_search(
            f"SELECT 0 AS qid, '{ONE_WORD}' AS word", sql_postings(), SQL_DOCUMENT_ENTITIES)})""",
    "search_top10": sql_search(SQL_SEARCH_WORDS, sql_postings(), SQL_DOCUMENT_ENTITIES),
    "search_top10_not_few": sql_search(
        SQL_SEARCH_WORDS, sql_postings(), SQL_DOCUMENT_ENTITIES
    ),
    "search_top10_benchmark_words": sql_search(
        SQL_BENCHMARK_WORDS, sql_postings(), SQL_DOCUMENT_ENTITIES
    ),
    "search_top10_conversations": SQL_CONVERSATIONS,
    "search_top10_conversation_parts": f"""
        SELECT qid, word, rank, doc_id, occurrences, name,
               CAST(i // {PART_SIZE} AS BIGINT) AS part, n_children,
               string_agg(label, ' ' ORDER BY i) AS children
        FROM (SELECT * EXCLUDE (part, children),
                     unnest(string_split(children, ' ')) AS label,
                     unnest(range(n_children)) AS i
              FROM ({SQL_CONVERSATIONS}))
        GROUP BY ALL""",
}
