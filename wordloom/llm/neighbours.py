"""Rows next to each other in a total order, without one task that sees all rows.

Rows are dealt to ranges of the key and sorted there. The first and last row of
each range are dealt to the range before and behind it, too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

SAMPLES = 32  # keys drawn for each range


def in_ranges(
    rows: DataFrame, key: str, tie: str, wrap: bool = False, least: int = 0
) -> DataFrame:
    """``rows`` sorted by (key, tie) within ranges of the key, with two columns more.

    ``_range`` numbers the ranges upwards. ``_side`` is 0, or -1 for a copy of
    the row before the range's first one, or 1 for a copy of the row behind its
    last one. Both columns must have no nulls. Bounds are drawn by a hash of the
    key; they only decide how even the ranges are. All rows of one key are in
    one range, so keys must be nearly unique. With ``wrap`` the very first row
    also follows the very last one. There are as many ranges as partitions of a shuffle,
    or ``least``, if that is more; each is one task.
    """
    spark = rows.sparkSession
    n = max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))
    number = _count_at_most(_bounds(rows, key, n), F.col(key), rows.schema[key].dataType)
    placed = rows.withColumn("_range", number.cast("int"))
    ends = placed.groupBy("_range").agg(
        F.min(F.struct(key, tie)).alias("first"), F.max(F.struct(key, tie)).alias("last")
    )
    ends = sorted(ends.collect(), key=lambda r: r["_range"])  # a row per range
    copies = [(b["_range"], *b["first"], a["_range"], 1) for a, b in zip(ends, ends[1:])]
    copies += [(a["_range"], *a["last"], b["_range"], -1) for a, b in zip(ends, ends[1:])]
    if wrap and ends:
        copies.append((ends[0]["_range"], *ends[0]["first"], ends[-1]["_range"], 1))
    types = [(c, rows.schema[c].dataType.simpleString()) for c in (key, tie)]
    schema = ", ".join(["_range int", *(f"{c} {t}" for c, t in types), "_to int", "_side int"])
    names = ["_range", key, tie]
    targets = (
        spark.createDataFrame(copies, schema)
        .groupBy(names)
        .agg(F.collect_list(F.struct(F.col("_to").alias("_range"), "_side")).alias("_targets"))
    )
    own = F.array(F.struct("_range", F.lit(0).alias("_side")))
    some = F.coalesce("_targets", F.array().cast("array<struct<_range: int, _side: int>>"))
    dealt = placed.join(F.broadcast(targets), names, "left").withColumn(
        "_place", F.explode(F.concat(own, some))
    )
    dealt = dealt.select(*rows.columns, "_place._range", "_place._side")
    return dealt.repartitionById(n, "_range").sortWithinPartitions("_range", "_side", key, tie)


def _bounds(rows: DataFrame, key: str, n: int) -> list:
    """At most n - 1 keys that part the rows about evenly, from a bounded draw."""
    keys = rows.select(key)
    count = keys.count()
    rate = max(1, count // (SAMPLES * n))
    drawn = keys.where(F.pmod(F.xxhash64(key), F.lit(rate)) == 0).limit(4 * SAMPLES * n)
    found = sorted(r[0] for r in drawn.distinct().collect())
    return sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []


def _count_at_most(bounds: list, key: Column, kind: DataType) -> Column:
    """How many bounds are at most ``key``: first among every so many of them, then between two."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    parts = [bounds[at : at + step] for at in range(0, len(bounds), step)]
    array = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    coarse = F.size(F.filter(array([p[0] for p in parts]), lambda b: b <= key))
    nested = F.array(*[array(p) for p in parts])
    fine = F.size(F.filter(F.get(nested, coarse - F.lit(1)), lambda b: b <= key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def neighbours(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[list[tuple[dict | None, dict, dict | None]]]:
    """Lists of (row before, row, row after) over sorted ranges."""
    before: dict | None = None
    row: dict | None = None
    out: list[tuple[dict | None, dict, dict | None]] = []
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            for after in batch.slice(at, size).to_pylist():
                same = row is not None and row["_range"] == after["_range"]
                if row is not None and row["_side"] == 0:
                    out.append((before, row, after if same else None))
                before, row = (row if same else None), after
            if len(out) >= size:
                yield out
                out = []
    if row is not None and row["_side"] == 0:
        out.append((before, row, None))
    if out:
        yield out
