"""Values taken out of delimited records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A label that holds the marker, or is an age such as 12.5, is
# not a name. The dot stands for any character.
ID_MARKER = "/m/"
AGE_PATTERN = r"\A[0-9]{2}.[0-9]{1}\z"

INTEGER_PATTERN = r"\A[+-]?[0-9]+\z"


def lenient_bigint(text: Column) -> Column:
    """The integer, or null where the text is none. Blanks are not trimmed.

    Only a text that is not how the integer itself is written meets the pattern.
    """
    number = text.try_cast("bigint")
    return F.when((number.cast("string") == text) | text.rlike(INTEGER_PATTERN), number)


def strict_bigint(text: Column) -> Column:
    """The integer; anything else fails the job, whatever the ANSI setting."""
    return F.coalesce(
        lenient_bigint(text),
        F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("NULL")))).cast(
            "bigint"
        ),
    )


def needs_fallback(
    label: Column, marker: str | None = ID_MARKER, pattern: str = AGE_PATTERN
) -> Column:
    """True where the label is not usable and the fallback column counts."""
    unusable = label.rlike(pattern)
    return unusable if marker is None else label.contains(marker) | unusable


def label_with_fallback(
    label: Column,
    fallback: Column,
    marker: str | None = ID_MARKER,
    pattern: str = AGE_PATTERN,
) -> Column:
    return F.when(needs_fallback(label, marker, pattern), fallback).otherwise(label)
