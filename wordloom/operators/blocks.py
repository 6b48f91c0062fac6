"""Posting lists in coded blocks: one row for so many postings of a word, by document.

A block has its least and greatest document and its largest count, so a
reader passes over blocks that cannot matter. Documents are stored as differences
from the least one, small numbers that Parquet packs; null ids are not coded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.scratch import kept, new_path, remove

BLOCK = 128  # postings in a block


def placed_in_lists(posts: DataFrame, *order: Column) -> DataFrame:
    """``posts`` with ``rank``, from 0: the place among the word's postings in the given order.

    Rows are dealt to ranges of (word, order), so a word that is in every document
    spreads over many; a rank is the place in the range plus the rows of the word
    in earlier ranges. The ranges are kept in the shared folder, as they are read twice;
    before that the rows are staged there, so that what made them runs once and not
    again for the sample of the ranges.
    """
    spark = posts.sparkSession
    stage = new_path(spark, "unplaced")
    try:
        posts.write.parquet(stage)
        ranged = spark.read.schema(posts.schema).parquet(stage)
        ranged = ranged.repartitionByRange(F.asc("word"), *order)
        ranged = kept(ranged.withColumn("_range", F.spark_partition_id()))
    finally:
        remove(spark, stage)
    earlier = Window.partitionBy("word").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("word", "_range")
        .agg(F.count("*").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    place = F.row_number().over(Window.partitionBy("word", "_range").orderBy(*order))
    placed = ranged.withColumn("_place", place).join(before, ["word", "_range"])
    rank = (F.col("_before") + F.col("_place") - 1).alias("rank")
    return placed.select(*posts.columns, rank)


def code_blocks(posts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, block, n, min_doc, max_doc, max_occurrences, gaps, counts) of postings of distinct
    (word, doc_id) without nulls; ``gaps`` and ``counts`` are in the order of documents."""
    placed = placed_in_lists(posts.select("word", "doc_id", "occurrences"), F.asc("doc_id"))
    pair = F.struct("doc_id", "occurrences")
    blocks = placed.groupBy("word", F.floor(F.col("rank") / block).alias("block")).agg(
        F.sort_array(F.collect_list(pair)).alias("_pairs")
    )
    least = F.get("_pairs", 0)["doc_id"]
    return blocks.select(
        "word",
        "block",
        F.size("_pairs").alias("n"),
        least.alias("min_doc"),
        F.element_at("_pairs", -1)["doc_id"].alias("max_doc"),
        F.array_max(F.transform("_pairs", lambda p: p["occurrences"])).alias("max_occurrences"),
        F.transform("_pairs", lambda p: p["doc_id"] - F.get("_pairs", 0)["doc_id"]).alias("gaps"),
        F.transform("_pairs", lambda p: p["occurrences"]).alias("counts"),
    )


def decode_blocks(blocks: DataFrame) -> DataFrame:
    """(word, doc_id, occurrences), one row for each posting."""
    pairs = F.arrays_zip("gaps", "counts")
    rows = blocks.select("word", "min_doc", F.explode(pairs).alias("_pair"))
    return rows.select(
        "word",
        (F.col("min_doc") + F.col("_pair.gaps")).alias("doc_id"),
        F.col("_pair.counts").alias("occurrences"),
    )


def postings_between(blocks: DataFrame, word: str, first: int, last: int) -> DataFrame:
    """The postings of a word in a range of documents; only blocks that reach into it are decoded."""
    reach = (F.col("word") == word) & (F.col("max_doc") >= first) & (F.col("min_doc") <= last)
    return decode_blocks(blocks.where(reach)).where(F.col("doc_id").between(first, last))


def postings_from(blocks: DataFrame, word: str, least: int) -> DataFrame:
    """The postings of a word with at least so many occurrences; lesser blocks are passed over."""
    rows = blocks.where((F.col("word") == word) & (F.col("max_occurrences") >= least))
    return decode_blocks(rows).where(F.col("occurrences") >= least)
