"""Words as numbers in the order of the words, so that what is shuffled and sorted is narrow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.heavy import heavy_keys, split_join
from wordloom.operators.joins import fits_broadcast, salted_join
from wordloom.scratch import kept


def term_dictionary(words: DataFrame) -> DataFrame:
    """(term_id, word) of the distinct words, numbered from 0 in their order, null left out.

    Words are dealt to ranges and numbered in each; a range's numbers begin behind
    the sizes of those before it, a running sum over as many rows as there are ranges. The
    ranges are kept in the shared folder.
    """
    distinct = words.select("word").where(F.col("word").isNotNull()).distinct()
    ranged = distinct.repartitionByRange("word").withColumn("_range", F.spark_partition_id())
    ranged = kept(ranged)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy("word"))
    placed = ranged.withColumn("_place", place).join(F.broadcast(starts), "_range")
    return placed.select((F.col("_start") + F.col("_place") - 1).alias("term_id"), "word")


def by_term_id(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, doc_id, occurrences) of postings whose words are all in the dictionary."""
    if fits_broadcast(terms):
        joined = posts.join(F.broadcast(terms), "word")
    else:
        # Only words with more than a task's share are repeated, not the whole dictionary.
        joined = split_join(posts, terms, "word", "inner", ["doc_id"], heavy_keys(posts, "word"))
    return joined.select("term_id", "doc_id", "occurrences")


def numbered_postings(posts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, doc_id, occurrences), summed over rows that repeat both, in order of both.

    The exchanges for the sum and the sort carry three numbers a row and no word.
    """
    numbers = by_term_id(posts, terms).groupBy("term_id", "doc_id")
    summed = numbers.agg(F.sum("occurrences").alias("occurrences"))
    return summed.orderBy("term_id", "doc_id")


def with_words(numbers: DataFrame, terms: DataFrame) -> DataFrame:
    """``numbers`` with the column ``word`` in front, for a sink."""
    if fits_broadcast(terms):
        joined = numbers.join(F.broadcast(terms), "term_id")
    else:
        joined = salted_join(numbers, terms, ["term_id"], "inner", ["doc_id"])
    return joined.select("word", *numbers.columns)
