"""Text normalization. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning does to a character. All other characters stay.
CLEANING = {"-": " ", ",": "", ".": "", '"': ""}

# Fixed value: the token delimiters. Not \s, which also matches vertical tab.
DELIMITERS = r"[ \t\n\r\f]+"
DELIMITER_CHARS = " \t\n\r\f"


def clean(text: Column) -> Column:
    """Lower-case the text and apply ``CLEANING``. Null stays null."""
    text = F.lower(text)
    for char, substitute in CLEANING.items():
        text = F.replace(text, F.lit(char), F.lit(substitute))
    return text


def tokenize(text: Column) -> Column:
    """Split cleaned text into an array of tokens.

    The first and the last element are empty strings where the text begins or
    ends with a delimiter; drop them after exploding, where the filter runs in
    generated code.
    """
    return F.split(text, DELIMITERS)
