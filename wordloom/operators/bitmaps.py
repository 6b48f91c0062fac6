"""Membership in long word lists by bitmaps: what is surely absent is told without a join.

The words of a list set bits in blocks of 32,768 by their hashes; a word that is in
the list has all its bits set, another one has with a small probability. The
blocks take 2 bytes a word, so they are broadcast where the words themselves
are too many. Of the words that may be in the list only the distinct ones
are shuffled and compared, to find those that are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.joins import BROADCAST_BYTES, fits_broadcast, salted_join
from wordloom.scratch import kept

BITS = 16  # of the bitmaps for each word
HASHES = 4  # bits that a word sets
BLOCK_BITS = 32_768  # fixed by Spark's bitmap aggregates


def bitmaps_fit(words: int) -> bool:
    return words * BITS // 8 <= BROADCAST_BYTES


def _places(word: Column) -> list[Column]:
    """The bits of a word in its block."""
    spread = F.xxhash64(F.lit(1), word)
    return [
        F.shiftrightunsigned(spread, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)
    ]


def _block(word: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(blocks))


def word_bitmaps(words: DataFrame, count: int) -> DataFrame:
    """(block, bits): the blocks of the words in a column ``word``, about ``count`` of them.

    ``bits`` is a list of 512 numbers. A block without words has no row.
    """
    blocks = max(1, -(-count * BITS // BLOCK_BITS))
    word = F.col("word")
    set_bits = words.select(
        _block(word, blocks).alias("block"), F.explode(F.array(*_places(word))).alias("place")
    )
    maps = set_bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("map"))
    part = "cast(conv(hex(substring(map, i * 8 + 1, 8)), 16, -10) as bigint)"
    bits = F.expr(f"transform(sequence(0, {BLOCK_BITS // 64 - 1}), i -> {part})")
    return maps.select("block", bits.alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    """A bit of a block; byte for byte the first bit of a map is the lowest of its byte."""
    number = F.get(bits, F.shiftright(place, 6).cast("int"))
    byte = F.shiftright(place, 3).bitwiseAND(F.lit(7))
    at = (F.lit(7) - byte) * 8 + place.bitwiseAND(F.lit(7))
    return F.getbit(number, at.cast("int")) == 1


def with_maybe(rows: DataFrame, words: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``_maybe``: false where ``word`` is surely not among the words, or null."""
    blocks = max(1, -(-count * BITS // BLOCK_BITS))
    maps = F.broadcast(word_bitmaps(words, count).withColumnRenamed("block", "_block"))
    word = F.col("word")
    found = rows.withColumn("_block", _block(word, blocks)).join(maps, "_block", "left")
    maybe = _is_set(F.col("bits"), _places(word)[0])
    for place in _places(word)[1:]:
        maybe = maybe & _is_set(F.col("bits"), place)
    return found.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).drop("_block", "bits")


def filter_by_bitmaps(rows: DataFrame, words: DataFrame, count: int, how: str) -> DataFrame:
    """The rows whose ``word`` is among the distinct words ("left_semi"), or is not ("left_anti").

    Reads ``rows`` twice: for the distinct words that may be in the list, and for
    the result. Those that are not in it after all, one in some hundred of the words
    outside the list, are kept in the shared folder and broadcast if they fit.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"how must be 'left_semi' or 'left_anti', not {how!r}")
    tested = with_maybe(rows, words, count)
    doubted = tested.where("_maybe").select("word").distinct()
    wrong = kept(doubted.join(words.select("word"), "word", "left_anti"))
    few = fits_broadcast(wrong)
    if how == "left_semi":
        hits = tested.where("_maybe").drop("_maybe")
        if few:
            return hits.join(F.broadcast(wrong), "word", "left_anti").select(rows.columns)
        return salted_join(hits, wrong, ["word"], "left_anti", ["doc_id"]).select(rows.columns)
    marked = wrong.withColumn("_wrong", F.lit(True))
    if few:
        joined = tested.join(F.broadcast(marked), "word", "left")
    else:
        joined = salted_join(tested, marked, ["word"], "left", ["doc_id"])
    passed = joined.where(~F.col("_maybe") | F.coalesce("_wrong", F.lit(False)))
    return passed.select(rows.columns)
