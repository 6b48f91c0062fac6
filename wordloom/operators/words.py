"""Documents to one row per token, and filters on tokens by word lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions import clean, tokenize
from wordloom.operators.bitmaps import bitmaps_fit, filter_by_bitmaps
from wordloom.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, salted_join, size_of
from wordloom.scratch import kept

# A list of up to this size becomes a set in the filter expression.
LITERAL_WORDS = 1_000
LITERAL_BYTES = 1024 * 1024


@dataclass(frozen=True)
class WordSet:
    """The distinct words of a list, measured once.

    ``listed`` holds them if they are few enough for a literal, else ``frame``
    has them in a column ``word``.
    """

    rows: int
    size: int
    listed: list[str] | None
    frame: DataFrame | None

    def fits(self, copies: int = 1, max_rows: int = BROADCAST_ROWS) -> bool:
        """Whether so many rows for each word, of about its width, fit a broadcast."""
        return self.rows * copies <= max_rows and self.size * copies <= BROADCAST_BYTES


WordList = Sequence[str] | DataFrame | WordSet | None


def tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, word), one row per token of the cleaned text."""
    words = tokenize(clean(F.col(text)))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(words).alias("word")).where(
        F.col("word") != ""
    )


def drop_stop_words(
    toks: DataFrame, stop_words: WordList, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Remove the tokens that equal an entry of the list, to the letter."""
    if stop_words is None:
        return toks
    stop = word_set(toks, stop_words)
    if stop.listed is not None:
        return toks.where(~F.col("word").isin(stop.listed)) if stop.listed else toks
    return _joined(toks, stop, "left_anti", broadcast_rows)


def keep_query_words(
    rows: DataFrame, words: WordList, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Keep the rows, tokens or postings, whose word is in the list.

    A short list turns into a literal IN, which the Parquet scan of a stored
    posting table uses to skip row groups.
    """
    keep = word_set(rows, words)
    if keep.listed is not None:
        return rows.where(F.col("word").isin(keep.listed) if keep.listed else F.lit(False))
    return _joined(rows, keep, "left_semi", broadcast_rows)


def _joined(rows: DataFrame, words: WordSet, how: str, broadcast_rows: int) -> DataFrame:
    if words.fits(max_rows=broadcast_rows):
        return rows.join(F.broadcast(words.frame), "word", how)
    if bitmaps_fit(words.rows):
        return filter_by_bitmaps(rows, words.frame, words.rows, how)
    return salted_join(rows, words.frame, ["word"], how, ["doc_id"])


def word_set(rows: DataFrame, words: WordList) -> WordSet:
    """The distinct words of a list or a DataFrame.

    A DataFrame is read for a literal first; only a longer one is kept in the
    shared folder and measured.
    """
    if isinstance(words, WordSet):
        return words
    if not isinstance(words, DataFrame):
        distinct = sorted(set(words))
        if (literal := _literal(distinct)) is not None:
            return literal
        words = rows.sparkSession.createDataFrame([(w,) for w in distinct], "word STRING")
    listed = words.select("word").where(F.col("word").isNotNull()).distinct()
    short = F.octet_length("word") <= LITERAL_BYTES // LITERAL_WORDS
    some = listed.select(F.when(short, F.col("word")).alias("word")).limit(LITERAL_WORDS + 1)
    found = [row["word"] for row in some.collect()]
    if None not in found and (literal := _literal(found)) is not None:
        return literal
    listed = kept(listed)
    return WordSet(*size_of(listed), None, listed)


def _literal(words: list[str]) -> WordSet | None:
    size = sum(len(w.encode()) + 16 for w in words)
    fits = len(words) <= LITERAL_WORDS and size <= LITERAL_BYTES
    return WordSet(len(words), size, words, None) if fits else None
