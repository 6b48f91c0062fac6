"""Joins in which a measured few of the keys are split, and all others stay as they are.

A sketch of frequent items finds the keys that hold more than a task's share of
the left side. Only their rows are dealt over salts, and only their rows on the
right are repeated, so nothing is left to a plan that is mended while it runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = 1_000  # heavy keys at most; a thousandth of the rows each is no more than that
TRACKED = 10_000  # keys that the sketch follows
LEAST = 10_000  # rows below which a key is no burden for a task, whatever its share


def heavy_keys(
    rows: DataFrame,
    key: str,
    share: float | None = None,
    most: int = KEYS,
    least: int = LEAST,
) -> list:
    """The keys of at least ``share`` of the rows and ``least`` of them, heaviest first.

    Left out, the share is that of a task if all were even. One pass with a sketch; its counts
    are too high by at most a few ten-thousandths of the rows, so no heavy key is missed.
    """
    if share is None:
        share = 1 / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(share, 1 / most)
    top = F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED, most)})")
    found = rows.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), top.alias("top")).first()
    least = max(least, share * found["n"])
    return [item["item"] for item in found["top"] or [] if item["count"] >= least]


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    salt_by: Sequence[str],
    heavy: list,
    salts: int | None = None,
) -> DataFrame:
    """Join on ``key`` with the rows of the ``heavy`` keys of ``left`` dealt over salts.

    Exact for inner, left, left_semi and left_anti, whichever keys are split.
    ``salt_by`` tells the rows of a key of ``left`` apart.
    """
    if not heavy:
        return left.join(right, key, how)
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False))
    salt = F.when(hot, F.pmod(F.xxhash64(*salt_by), F.lit(salts))).otherwise(0).cast("int")
    every = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = left.withColumn("_salt", salt)
    right = right.withColumn("_salt", F.explode(every))
    return left.join(right, [key, "_salt"], how).drop("_salt")
