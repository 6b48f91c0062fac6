"""Joins against a list whose size is not known beforehand.

The left side may be skewed: a third of its rows may share one key. A right
side that is measured to be small is broadcast, so the left side does not move.
A larger one is repeated once per salt, and the rows of a hot key on the left
spread over all salts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def size_of(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``, measured with one aggregation."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    width = reduce(lambda a, b: a + b, widths)
    size = df.agg(F.count("*").alias("n"), F.sum(width.cast("bigint")).alias("size")).first()
    return size["n"], size["size"] or 0


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    n, size = size_of(df)
    return n <= max_rows and size <= max_bytes


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    salts: int = SALTS,
) -> DataFrame:
    """Exact for inner, left, left_semi and left_anti: each left row has one salt
    and meets every right row of its key there."""
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    left = left.withColumn("_salt", salt)
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")

