"""Posting lists in the order of their impact, read only as far as an answer needs.

A word's postings are stored best first, in blocks of a fixed length, and blocks in
tiers that double: tier t holds the blocks from 2**t - 1 on. Beside them is a row for
each block with its best posting. A search reads tier after tier, and in each
only the words of which an unread block could still enter the answer. So what it
reads follows the length of the answer, and not that of the lists.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.blocks import BLOCK, placed_in_lists
from wordloom.operators.topk import (
    TOP,
    best_first,
    few_hits,
    few_ids,
    restrict_literally,
    search,
    top_matched,
)
from wordloom.operators.words import WordSet, keep_query_words, word_set
from wordloom.scratch import cleared, kept, new_path

POSTINGS = "tier INT, block BIGINT, word STRING, doc_id BIGINT, occurrences BIGINT"
BLOCKS = "word STRING, block BIGINT, n BIGINT, max_occurrences BIGINT, first_doc BIGINT"


@dataclass(frozen=True)
class ImpactIndex:
    """The folders of an index: ``postings`` by tier, and ``blocks`` of so many postings."""

    path: str
    block: int = BLOCK

    @property
    def postings(self) -> str:
        return f"{self.path}/postings"

    @property
    def blocks(self) -> str:
        return f"{self.path}/blocks"

    def read_postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(POSTINGS).parquet(self.postings)

    def read_blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCKS).parquet(self.blocks)


def _tier(block: Column) -> Column:
    """The tier of a block: 0 for block 0, 1 for the next two, 2 for the next four."""
    return (F.length(F.bin(block + 1)) - 1).cast("int")


def write_impact_index(posts: DataFrame, path: str, block: int = BLOCK) -> ImpactIndex:
    """Store postings of distinct (word, doc_id) best first, and a row for each block.

    Both replace what was at ``path``. Files of a tier are sorted by word, so a
    list of words skips most row groups of those tiers that are read at all.
    Words must not be null.
    """
    index = ImpactIndex(path, block)
    spark = posts.sparkSession
    posts = posts.select("word", "doc_id", "occurrences")
    with cleared(spark):
        ranked = placed_in_lists(posts, *best_first())
        stage = new_path(spark, "impact")
        ranked.withColumn("block", F.floor(F.col("rank") / block)).write.parquet(stage)
        rows = spark.read.parquet(stage).withColumn("tier", _tier(F.col("block")))
        rows = rows.select(*[c.split()[0] for c in POSTINGS.split(", ")])
        sort = ["tier", "word", "block", F.desc("occurrences"), "doc_id"]
        rows = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
        rows.write.mode("overwrite").partitionBy("tier").parquet(index.postings)
    blocks = index.read_postings(spark).groupBy("word", "block").agg(
        F.count("*").alias("n"),
        F.max("occurrences").alias("max_occurrences"),
        F.min_by("doc_id", F.struct(-F.col("occurrences"), "doc_id")).alias("first_doc"),
    )
    blocks = blocks.repartitionByRange("word", "block").sortWithinPartitions("word", "block")
    blocks.write.mode("overwrite").parquet(index.blocks)
    return index


def _pending(blocks: DataFrame, found: DataFrame | None, tier: int, k: int) -> DataFrame:
    """The asked words with a block in ``tier`` or behind it that could still enter their answer.

    That is so while fewer than k are found, or if the best posting not read
    goes before the last one found. Lists are sorted, so the head of the first
    block of the tier is the best of all that are left.
    """
    heads = blocks.where(F.col("block") == 2**tier - 1)
    if found is None:
        return heads.select("word")
    last = found.groupBy("word").agg(
        F.count("*").alias("_n"),
        F.max(F.struct(-F.col("occurrences"), F.col("doc_id"))).alias("_last"),
    )
    head = F.struct(-F.col("max_occurrences"), F.col("first_doc"))
    enters = F.col("_n").isNull() | (F.col("_n") < k) | (head < F.col("_last"))
    return heads.join(last, "word", "left").where(enters).select("word")


def top_by_impact(
    spark: SparkSession, index: ImpactIndex, entity_ids: DataFrame, words: WordSet, k: int = TOP
) -> tuple[DataFrame, list[int]]:
    """(word, doc_id, occurrences, rank), and how many words read each tier.

    The k best postings of each word whose documents are among the distinct
    ``entity_ids``. Each tier is one job on the words still open, kept in the shared
    folder; there are as many as the logarithm of the longest list read has.
    """
    blocks = keep_query_words(index.read_blocks(spark), words)
    ids = entity_ids.select(F.col(entity_ids.columns[0]).alias("doc_id"))
    found: DataFrame | None = None
    read: list[int] = []
    while True:
        tier = len(read)
        still = kept(_pending(blocks, found, tier, k))
        open_words = still.count()
        if not open_words:
            break
        read.append(open_words)
        rows = index.read_postings(spark).where(F.col("tier") == tier)
        asked = word_set(rows, still)
        rows = keep_query_words(rows, asked).drop("tier", "block")
        few = asked.fits(copies=index.block * 2**tier)  # so many rows at most for each word
        hits = ids.join(F.broadcast(rows) if few else rows, "doc_id")
        hits = hits.select("word", "doc_id", "occurrences")
        if found is not None:
            hits = found.drop("rank").unionByName(hits)
        found = kept(top_matched(hits, k))
    if found is None:
        found = spark.createDataFrame([], "word STRING, doc_id BIGINT, occurrences BIGINT, rank INT")
    return found, read


def search_by_impact(
    index: ImpactIndex, entities: DataFrame, words: DataFrame, k: int = TOP
) -> DataFrame:
    """Answer (qid, word) rows from an index in the order of impact.

    The rows are those of ``search_tables``: words as typed, a repeated word for
    each qid, equal counts by id.
    """
    spark = entities.sparkSession
    wanted = word_set(entities, words)
    ids = entities.where(F.col("part") == 0).select("entity_id")
    top, _ = top_by_impact(spark, index, ids, wanted, k)
    few = few_ids(top)
    if few is not None:
        entities = restrict_literally(entities, few)
    return search(top, entities, words, few_hits(wanted, k))
