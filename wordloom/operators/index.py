"""Posting tables: how often a word occurs in a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from wordloom.functions import clean, tokenize
from wordloom.operators.enrich import last_per_key


def raw_postings(toks: DataFrame) -> DataFrame:
    """One posting per occurrence. Needs no shuffle."""
    return toks.select("word", "doc_id", F.lit(1).cast("bigint").alias("occurrences"))


def postings(toks: DataFrame) -> DataFrame:
    """One posting per (word, doc_id).

    Hashing on both columns spreads a word that is in every document as well
    as an id that holds much of the text.
    """
    return toks.groupBy("word", "doc_id").agg(F.count("*").alias("occurrences"))


def summed_postings(posts: DataFrame) -> DataFrame:
    """One posting per (word, doc_id) from raw or repeated ones."""
    return posts.groupBy("word", "doc_id").agg(F.sum("occurrences").alias("occurrences"))


def summed_in_order(posts: DataFrame) -> DataFrame:
    """As ``summed_postings``, for rows that are sorted by word and id in any case.

    The greatest word of each group is no more than its word, but as a string it has
    Spark sum along the sorted rows, with no table of all keys in memory before the sort.
    """
    sums = [F.sum("occurrences").alias("occurrences"), F.max("word").alias("_greatest")]
    return posts.groupBy("word", "doc_id").agg(*sums).where("_greatest <=> word").drop("_greatest")


def row_postings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One posting per word and row of ``docs``; no shuffle.

    The postings of (word, doc_id) where ids are unique. The tokens of a row are
    sorted, and a word counts from its first place to the first of the next word.
    """
    return counted_rows(docs, F.col(doc_id), tokenize(clean(F.col(text))))


def counted_rows(rows: DataFrame, doc_id: Column, words: Column) -> DataFrame:
    """``row_postings`` of rows with an array of words, of which empty ones do not count."""
    ordered = rows.select(doc_id.alias("doc_id"), F.sort_array(words).alias("_words"))
    places = F.sequence(F.lit(0), F.size("_words") - 1)
    firsts = F.filter(
        places, lambda i: ~F.get("_words", i).eqNullSafe(F.get("_words", i - 1))
    )
    counted = F.transform(
        "_firsts",
        lambda first, n: F.struct(
            F.get("_words", first).alias("word"),
            (F.coalesce(F.get("_firsts", n + 1), F.size("_words")) - first)
            .cast("bigint")
            .alias("occurrences"),
        ),
    )
    return (
        ordered.select("*", firsts.alias("_firsts"))
        .select("doc_id", F.inline(counted))
        .where(F.col("word") != "")
        .select("word", "doc_id", "occurrences")
    )


# Ids from 0 with up to so many digits have their text order as one BIGINT.
PACKED_DIGITS = 17


def text_order(number: Column) -> tuple[Column, Column]:
    """(packed, wide): numbers in the order of their decimal texts, of which one is not null.

    ``packed``, a BIGINT, is for ids from 0 with up to 17 digits: the digits moved
    to the left, then their number, since 1 stands before 10. ``wide``, a decimal,
    is for all others, which are rare. Null, before all, is -1 in ``packed``.
    """
    short = F.lit(10**PACKED_DIGITS)
    length = F.length(number.cast("string"))
    tens = F.element_at(F.array(*[F.lit(10**i) for i in range(PACKED_DIGITS)]), 1 - length + PACKED_DIGITS)
    inside = (number >= 0) & (number < short)
    packed = F.when(inside, number * tens * 20 + length).when(number.isNull(), F.lit(-1))
    digits = F.replace(number.cast("string"), F.lit("-"), F.lit(""))
    left = F.rpad(digits, 19, "0").cast("decimal(19,0)") * F.lit(20).cast("decimal(2,0)")
    place = (left + F.length(digits).cast("decimal(2,0)")).cast("decimal(22,0)")
    below = F.lit(str(10**21)).cast("decimal(22,0)")  # a minus stands before all digits
    wide = F.when(number < 0, place - below).when(number >= short, place)
    return packed.cast("bigint"), wide.cast("decimal(23,0)")


def last_posting_per_word(posts: DataFrame) -> DataFrame:
    """The posting with the greatest id, compared as text, so 2 comes after 10.

    Ids of a BIGINT column are packed into numbers in the order of their texts, so
    that the greatest of each word is kept by hash aggregation on both sides of the
    shuffle, with no sort of the postings. Any other column is compared as it is.
    """
    if not isinstance(posts.schema["doc_id"].dataType, LongType):
        return last_per_key(posts, ["word"], [F.col("doc_id").cast("string")])
    packed, wide = text_order(F.col("doc_id"))
    rows = posts.select("word", "occurrences", "doc_id", packed.alias("_packed"), wide.alias("_wide"))
    best = []
    for order in ("_packed", "_wide"):
        best.append(F.max(order).alias(order))
        best += [F.max_by(c, order).alias(order + c) for c in ("doc_id", "occurrences")]
    last = rows.groupBy("word").agg(*best)
    # Both orders as one: a packed id has 17 places where a wide one has 19.
    length = F.pmod("_packed", F.lit(20)).cast("decimal(2,0)")
    both = (F.col("_packed").cast("decimal(22,0)") - length) * F.lit(100).cast("decimal(3,0)") + length
    wins = F.col("_wide").isNotNull() & (
        F.col("_packed").isNull() | (F.col("_packed") < 0) | (F.col("_wide") > both)
    )
    pick = lambda c: F.when(wins, F.col("_wide" + c)).otherwise(F.col("_packed" + c)).alias(c)
    return last.select("word", pick("doc_id"), pick("occurrences"))
