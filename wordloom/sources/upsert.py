"""Stored tables that take new rows key by key.

A table is a folder of key ranges, each a folder of its own, besides the bounds
that part them. An upsert replaces all rows of each key that it brings, so that a
shorter list leaves nothing of a longer one, and writes only the ranges it touches;
files of all others stay as they are. Rows carry the number of the upsert that wrote
them, so that what changed since a number is read without a comparison.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wordloom.operators.joins import fits_broadcast, salted_join
from wordloom.scratch import new_path, remove

RANGE, GENERATION = "key_range", "generation"
BOUNDS = "_bounds"  # a folder that scans of the table pass over

# Ranges of a table whose caller does not set their number hold about so many rows at first, and
# a task sorts about so many.
RANGE_ROWS = 1_000_000
ACCURACY = 10_000


def create_ranged(
    df: DataFrame, path: str, keys: Sequence[str], ranges: int | None = None
) -> None:
    """Write ``df`` as a ranged table by the first of ``keys``, an integer, as generation 1.

    Replaces what was at ``path``. Bounds are quantiles of the first key, within a
    ten-thousandth of the rows; null is in the first range. The other keys order the
    rows of one, and files are cut between them where one has very many.
    """
    key = keys[0]
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} must be an integer column")
    if {RANGE, GENERATION} & set(df.columns):
        raise ValueError(f"{RANGE} and {GENERATION} are columns of the table itself")
    spark = df.sparkSession
    stage = new_path(spark, "ranged")
    try:
        df.write.parquet(stage)
        rows = spark.read.schema(df.schema).parquet(stage)
        known = rows.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull())
        ranges = ranges or max(1, -(-known.count() // RANGE_ROWS))
        shares = [i / ranges for i in range(1, ranges)]
        quantiles = F.percentile_approx(key, shares, ACCURACY) if shares else F.array()
        found = known.agg(quantiles.cast("array<bigint>").alias("bounds")).first()["bounds"]
        bounds = sorted(set(found or []))
        _write(rows.withColumn(GENERATION, F.lit(1).cast("bigint")), path, keys, bounds, "static")
        meta = spark.createDataFrame([(list(keys), bounds)], "keys array<string>, bounds array<bigint>")
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BOUNDS}")
    finally:
        remove(spark, stage)


def read_ranged(spark: SparkSession, path: str, since: int = 0) -> DataFrame:
    """The rows of the table with their ``generation``, those after ``since``."""
    rows = spark.read.parquet(path).drop(RANGE)
    return rows.where(F.col(GENERATION) > since) if since else rows


def upsert(rows: DataFrame, path: str, deleted: DataFrame | None = None) -> int:
    """Replace all rows of the keys of ``rows``, remove those of ``deleted``; the new generation.

    ``rows`` has the columns of the table, ``deleted`` the key. Keys are compared
    with null as a value. The rows and what they leave of the ranges they touch are
    staged in the shared folder before anything is replaced, so a job that fails
    until then changes nothing.
    """
    spark = rows.sparkSession
    meta = spark.read.parquet(f"{path}/{BOUNDS}").first()
    order, bounds = meta["keys"], meta["bounds"]
    key = order[0]
    table = spark.read.parquet(path)
    generation = 1 + (table.agg(F.max(GENERATION)).first()[0] or 0)
    columns = [c for c in table.columns if c not in (RANGE, GENERATION)]
    stage = new_path(spark, "upsert")
    try:
        number = F.lit(generation).cast("bigint").alias(GENERATION)
        _cast(rows, table, columns).select("*", number).write.parquet(f"{stage}/new")
        new = spark.read.parquet(f"{stage}/new")
        keys = new.select(key)
        if deleted is not None:
            keys = keys.unionByName(deleted.select(F.col(key).cast(new.schema[key].dataType)))
        keys.distinct().write.parquet(f"{stage}/keys")
        keys = spark.read.parquet(f"{stage}/keys")
        touched = keys.select(_range(F.col(key), bounds).alias(RANGE)).distinct().collect()
        touched = sorted(r[RANGE] for r in touched)
        if not touched:
            return generation - 1
        old = table.where(F.col(RANGE).isin(touched))
        left = _without(old, keys, key).select(*columns, GENERATION)
        left.unionByName(new).write.parquet(f"{stage}/whole")
        whole = spark.read.parquet(f"{stage}/whole")
        _write(whole, path, order, bounds, "dynamic")
        full = whole.select(_range(F.col(key), bounds).alias(RANGE)).distinct().collect()
        for empty in set(touched) - {r[RANGE] for r in full}:
            _remove_range(spark, path, empty)
        return generation
    finally:
        remove(spark, stage)


def _cast(rows: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in columns])


def _without(old: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among the distinct ``keys``; null is a key like others."""
    plain = keys.where(F.col(key).isNotNull())
    has_null = not keys.where(F.col(key).isNull()).isEmpty()
    nulls = old.where(F.lit(False) if has_null else F.col(key).isNull())
    old = old.where(F.col(key).isNotNull())
    if fits_broadcast(plain):
        kept = old.join(F.broadcast(plain), key, "left_anti")
    else:
        kept = salted_join(old, plain, [key], "left_anti", [c for c in old.columns if c != key][:1])
    return kept.unionByName(nulls.select(kept.columns))


def _range(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the key: first among every so many of them, then between two."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    parts = [bounds[at : at + step] for at in range(0, len(bounds), step)]
    at_most = lambda values: F.size(F.filter(values, lambda b: b <= key))
    coarse = at_most(F.array(*[F.lit(p[0]).cast("bigint") for p in parts]))
    nested = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in p]) for p in parts])
    fine = at_most(F.get(nested, coarse - F.lit(1)))
    number = F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)
    return F.coalesce(F.when(key.isNotNull(), number), F.lit(0)).cast("int")


def _write(rows: DataFrame, path: str, keys: Sequence[str], bounds: list[int], mode: str) -> None:
    """Sorted files, range by range; "dynamic" replaces only the ranges that have rows.

    Ranges grow with the table while their bounds stay, so rows, too, set how many tasks there are.
    """
    placed = rows.withColumn(RANGE, _range(F.col(keys[0]), bounds))
    tasks = max(len(bounds) + 1, -(-rows.count() // RANGE_ROWS))
    placed = placed.repartitionByRange(tasks, RANGE, *keys)
    writer = placed.sortWithinPartitions(RANGE, *keys).write.mode("overwrite").partitionBy(RANGE)
    writer.option("partitionOverwriteMode", mode).parquet(path)


def _remove_range(spark: SparkSession, path: str, number: int) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{RANGE}={number}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
