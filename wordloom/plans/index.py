"""From documents to tokens, postings and entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import plain_quotes
from wordloom.operators import (
    drop_stop_words,
    parent_child_list,
    postings,
    row_postings,
    summed_postings,
    tokens,
)
from wordloom.operators.joins import fits_broadcast
from wordloom.operators.words import WordList, word_set
from wordloom.scratch import kept


def corpus_tokens(docs: DataFrame, stop_words: WordList = None) -> DataFrame:
    """The tokens that count: cleaned, and not in the stop list."""
    return drop_stop_words(tokens(docs), stop_words)


def build_index(
    docs: DataFrame, stop_words: WordList = None, unique_ids: bool = False
) -> DataFrame:
    """Postings without stop words.

    The ids that come in several rows are measured by a pass over the id column and kept
    in the shared folder. Only tokens of their rows are grouped by word and id; all other
    rows are counted by themselves, without a shuffle or a table of their postings in
    memory. With very many such ids all tokens are grouped.

    With ``unique_ids`` each row is counted by itself, without a shuffle. That
    ids are unique is checked by a pass over the id column; where they are not,
    the counts of the rows are summed.
    """
    if not unique_ids:
        return _grouped(docs, stop_words)
    posts = drop_stop_words(row_postings(docs), stop_words)
    return posts if ids_are_unique(docs) else summed_postings(posts)


def _grouped(docs: DataFrame, stop_words: WordList) -> DataFrame:
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    ids = kept(ids.select(F.col("doc_id").alias("_repeated")))
    stop = None if stop_words is None else word_set(docs, stop_words)
    if not fits_broadcast(ids):
        return postings(corpus_tokens(docs, stop))
    same, ids = F.col("doc_id").eqNullSafe(F.col("_repeated")), F.broadcast(ids)
    single = row_postings(docs.join(ids, same, "left_anti"))
    shared = postings(corpus_tokens(docs.join(ids, same, "left_semi"), stop))
    return drop_stop_words(single, stop).unionByName(shared)


def ids_are_unique(docs: DataFrame) -> bool:
    return docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def build_entities(
    parents: DataFrame,
    children: DataFrame,
    order_by: Sequence[str] = ("pos",),
    part_length: int | None = None,
) -> DataFrame:
    return plain_entities(parent_child_list(parents, children, order_by, part_length))


def plain_entities(entities: DataFrame) -> DataFrame:
    """Double quotes in names and children turned into single ones."""
    return entities.withColumns(
        {
            "name": plain_quotes(F.col("name")),
            "children": F.transform("children", plain_quotes),
        }
    )
