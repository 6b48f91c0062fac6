"""Batch search: all query words in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators import keep_query_words, parent_child_list, postings, restrict_to
from wordloom.operators.heavy import LEAST
from wordloom.operators.joins import BROADCAST_ROWS
from wordloom.operators.topk import (
    TOP,
    best_of_word,
    few_hits,
    few_ids,
    restrict_literally,
    search,
    top_matched,
    top_postings,
)
from wordloom.operators.words import WordList, word_set
from wordloom.plans.index import corpus_tokens
from wordloom.scratch import kept


def search_tables(
    posts: DataFrame, entities: DataFrame, words: DataFrame, k: int = TOP
) -> DataFrame:
    """Answer (qid, word) rows from stored postings and entities.

    The words are measured once. The winners are kept in the shared folder; if
    they are few, their ids go to the scan of the entities.
    """
    wanted = word_set(posts, words)
    ids = entities.where(F.col("part") == 0).select("entity_id")
    top = kept(top_postings(keep_query_words(posts, wanted), ids, k))
    found = few_ids(top)
    if found is not None:
        entities = restrict_literally(entities, found)
    return search(top, entities, words, few_hits(wanted, k))


def search_bucketed(
    posts: DataFrame, entities: DataFrame, words: DataFrame, k: int = TOP
) -> DataFrame:
    """As ``search_tables``, for tables stored in the same buckets, of ``doc_id`` and ``entity_id``.

    Postings meet the ids of the entities bucket by bucket, so that neither moves,
    however many postings the words have.
    """
    wanted = word_set(posts, words)
    ids = entities.where(F.col("part") == 0).select(F.col("entity_id").alias("doc_id"))
    met = keep_query_words(posts, wanted).join(ids.hint("merge"), "doc_id")
    top = kept(top_matched(met.select(*posts.columns), k))
    found = few_ids(top)
    if found is not None:
        entities = restrict_literally(entities, found)
    return search(top, entities, words, few_hits(wanted, k))


def search_documents(
    docs: DataFrame,
    parents: DataFrame,
    children: DataFrame,
    words: DataFrame,
    stop_words: WordList = None,
    k: int = TOP,
    order_by: Sequence[str] = ("pos",),
    part_length: int | None = None,
    few: bool | None = None,
    heavy_rows: int = LEAST,
) -> DataFrame:
    """Answer (qid, word) rows from the documents, without a stored index.

    Only tokens of query words are counted, and only the parents and children
    of the winners are joined and listed. The winners are read several times,
    so they are kept in the shared folder. ``few`` tells whether the winners may be
    broadcast; left out, the words are measured. Where they may not, words asked and
    documents answered more than ``heavy_rows`` times, and more than a task's share, are split.
    """
    wanted = word_set(docs, words)
    few = few_hits(wanted, k) if few is None else few
    ids = parents.select("entity_id").distinct()
    posts = postings(keep_query_words(corpus_tokens(docs, stop_words), wanted))
    top = kept(top_postings(posts, ids, k))
    entities = _entities_of(top, parents, children, order_by, part_length, few)
    return search(top, entities, words, few, heavy_rows)


def search_word(
    posts: DataFrame,
    parents: DataFrame,
    children: DataFrame,
    word: str,
    k: int = TOP,
    order_by: Sequence[str] = ("pos",),
    part_length: int | None = None,
) -> DataFrame:
    """The k best entities of one word: (word, doc_id, occurrences, name, part, children).

    Parents and children are restricted to the winners before any list is made.
    """
    best = kept(best_of_word(posts, parents.select("entity_id").distinct(), word, k))
    few = k <= BROADCAST_ROWS
    entities = _entities_of(best, parents, children, order_by, part_length, few)
    best = F.broadcast(best) if few else best
    found = entities.join(best, F.col("entity_id") == F.col("doc_id"))
    columns = ["word", "doc_id", "occurrences", "name", "part", "children"]
    return found.select(*columns).orderBy(F.desc("occurrences"), "doc_id", "part")


def _entities_of(
    top: DataFrame,
    parents: DataFrame,
    children: DataFrame,
    order_by: Sequence[str],
    part_length: int | None,
    few: bool,
) -> DataFrame:
    found = few_ids(top)
    if found is not None:
        parents, children = (restrict_literally(rows, found) for rows in (parents, children))
    else:
        winners = top.select(F.col("doc_id").alias("entity_id")).distinct()
        parents, children = (
            restrict_to(rows, winners, few, order_by) for rows in (parents, children)
        )
    return parent_child_list(parents, children, order_by, part_length)
