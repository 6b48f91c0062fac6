"""The best documents per query word, with their names and children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.heavy import LEAST, heavy_keys, split_join
from wordloom.operators.words import WordSet
from wordloom.scratch import kept

TOP = 10

# Up to so many ids become a literal, which the scan of a stored table uses.
LITERAL_IDS = 1_000

ANSWER = [
    "qid", "word", "rank", "doc_id", "occurrences", "name", "part", "n_children", "children",
]


def best_first() -> list[Column]:
    return [F.desc("occurrences"), F.asc("doc_id")]


def top_per_key(
    rows: DataFrame, key: str, order: Sequence[Column], k: int, salt_by: Sequence[str]
) -> DataFrame:
    """The first ``k`` rows of each key, with their ``rank``.

    Cut twice: first to k rows per key and salt, which bounds what one task gets
    for a hot key to k times the salts, whatever the number of input partitions.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)))
    cut = _first_rows(salted, [key, "_salt"], order, k, "_cut").drop("_salt", "_cut")
    return _first_rows(cut, [key], order, k, "rank")


def _first_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def match_words(posts: DataFrame, entity_ids: DataFrame) -> DataFrame:
    """The postings of documents that are entities. ``entity_ids`` is distinct."""
    ids = entity_ids.select(F.col(entity_ids.columns[0]).alias("doc_id"))
    return posts.join(ids, "doc_id").select(*posts.columns)


def top_postings(posts: DataFrame, entity_ids: DataFrame, k: int = TOP) -> DataFrame:
    """(word, doc_id, occurrences, rank): k per word, for postings of query words.

    Only ids of the entities take part here. Their names and lists are joined
    to what is left after the cut.
    """
    return top_matched(match_words(posts, entity_ids), k)


def top_matched(posts: DataFrame, k: int = TOP) -> DataFrame:
    """(word, doc_id, occurrences, rank): k per word, for postings of entities."""
    return top_per_key(posts, "word", best_first(), k, ["doc_id"])


def few_hits(words: WordSet, k: int = TOP) -> bool:
    """True if k rows for each of the words are measured to fit a broadcast."""
    return words.fits(copies=k)


def search(
    top: DataFrame,
    entities: DataFrame,
    words: DataFrame,
    few: bool,
    heavy_rows: int = LEAST,
) -> DataFrame:
    """Answer every (qid, word) from ``top``, in query order.

    ``top`` has at most k rows per distinct word. Words meet it first, which
    moves narrow rows only; names and lists come last, each list once.
    Words are used as typed, and a repeated word is answered for each qid. Where
    ``top`` is measured to be small (``few``), it is broadcast, and the answers are
    sorted. Else words and documents with more than a task's share of the answers, and
    ``heavy_rows``, are measured and split; the narrow answers are put in order and
    kept in the shared folder, and lists go to the place of their answer, so that
    they are joined once and not again for a sample of the order.
    """
    if few:
        hits = words.join(F.broadcast(top), "word").withColumnRenamed("doc_id", "entity_id")
        found = hits.join(entities, "entity_id").withColumnRenamed("entity_id", "doc_id")
        return found.select(*ANSWER).orderBy("qid", "rank", "part")
    heavy = heavy_keys(words, "word", least=heavy_rows)
    hits = split_join(words, top, "word", "inner", ["qid"], heavy)
    hits = hits.withColumnRenamed("doc_id", "entity_id").repartitionByRange("qid", "rank")
    hits = kept(hits.withColumn("_place", F.spark_partition_id()))
    places = 1 + (hits.agg(F.max("_place")).first()[0] or 0)
    heavy = heavy_keys(hits, "entity_id", least=heavy_rows)
    found = split_join(hits, entities, "entity_id", "inner", ["qid", "rank"], heavy)
    found = found.withColumnRenamed("entity_id", "doc_id").repartitionById(places, "_place")
    return found.sortWithinPartitions("qid", "rank", "part").select(*ANSWER)


def restrict_literally(rows: DataFrame, ids: list[int]) -> DataFrame:
    """The rows with one of few ids; the filter reaches a scan."""
    return rows.where(F.col("entity_id").isin(ids) if ids else F.lit(False))


def few_ids(top: DataFrame, limit: int = LITERAL_IDS) -> list[int] | None:
    """The documents of ``top`` if it has at most ``limit`` rows, else None."""
    found = top.select("doc_id").limit(limit + 1).collect()
    return sorted({row["doc_id"] for row in found}) if len(found) <= limit else None


def best_of_word(posts: DataFrame, entity_ids: DataFrame, word: str, k: int = TOP) -> DataFrame:
    """(word, doc_id, occurrences): the k best of one word.

    The filter on the word reaches the scan of a stored table, and the sort
    keeps k rows per partition.
    """
    hits = match_words(posts.where(F.col("word") == word), entity_ids)
    return hits.orderBy(*best_first()).limit(k)
