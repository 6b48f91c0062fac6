"""Tables whose rows are stored by the hash of a key, so that joins on it move nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.scratch import new_path, remove
from wordloom.sources import writers


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    buckets: int,
    sort: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """A table by name with files for each bucket of ``key``, sorted by it and ``sort``.

    A bucket has one file, or several where that would hold more than about ``FILE_ROWS``, each
    written by a task of its own. Rows are staged in the shared folder to be counted, and dealt
    once, when the table is written. Two tables with the same number
    of buckets join on their keys, and each is grouped by its key, without an
    exchange. A key's rows are in one file, so this is for keys that are nearly
    even, such as documents and entities, and not for words. Replaces what
    was at the table, and at ``path`` where it is to lie.
    """
    spark = df.sparkSession
    stage = new_path(spark, "stage")
    try:
        df.write.parquet(stage)
        rows = spark.read.schema(df.schema).parquet(stage)
        shares = max(1, -(-rows.count() // (buckets * writers.FILE_ROWS)))
        # The place of a row's bucket in the table, and a share of that by another hash.
        bucket = F.pmod(F.hash(key), F.lit(buckets))
        share = F.pmod(F.xxhash64(key), F.lit(shares)).cast("int")
        dealt = rows.repartitionById(buckets * shares, bucket * shares + share)
        writer = dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *sort)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
    finally:
        remove(spark, stage)
