"""Stored tables that follow their text: new documents and entities without a new load.

Postings are kept by document and entities by id, each a ranged table. What
comes anew replaces all that was stored of a document or entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import summed_postings
from wordloom.plans.index import plain_entities
from wordloom.plans.programs import last_lists
from wordloom.scratch import cleared
from wordloom.sources.lines import parse_entities, parse_postings
from wordloom.sources.readers import PART_FILES, read_lines, strict
from wordloom.sources.upsert import create_ranged, read_ranged, upsert

POSTING_KEYS = ["doc_id", "word"]
ENTITY_KEYS = ["entity_id", "part"]


def stored_postings(lines: DataFrame) -> DataFrame:
    """(word, doc_id, occurrences) of lines ``word id count``; those of one word and document are summed."""
    return summed_postings(strict(parse_postings(lines)))


def stored_entities(lines: DataFrame, in_parts: bool = False) -> DataFrame:
    """Entities of lines, the last list of each id alone, in single quotes."""
    return plain_entities(last_lists(strict(parse_entities(lines, in_parts))))


def create_updatable(
    spark: SparkSession,
    index: str,
    entities: str,
    posting_table: str,
    entity_table: str,
    in_parts: bool = False,
    ranges: int | None = None,
) -> None:
    """Text output of the writers to two ranged tables, replaced as a whole."""
    with cleared(spark):
        create_ranged(
            stored_postings(read_lines(spark, index, PART_FILES)), posting_table, POSTING_KEYS, ranges
        )
        lists = stored_entities(read_lines(spark, entities, PART_FILES), in_parts)
        create_ranged(lists, entity_table, ENTITY_KEYS, ranges)


def update_tables(
    spark: SparkSession,
    posting_table: str,
    entity_table: str,
    index: str | None = None,
    entities: str | None = None,
    in_parts: bool = False,
    gone: DataFrame | None = None,
) -> None:
    """Bring text of new or changed documents and entities into the tables.

    A document that comes again loses all its former postings, an entity its
    former list. ``gone`` holds ids, in its first column, of documents and
    entities to remove.
    """
    ids = lambda name: None if gone is None else gone.select(F.col(gone.columns[0]).alias(name))
    if index is not None or gone is not None:
        posts = _none(spark, posting_table) if index is None else stored_postings(
            read_lines(spark, index, PART_FILES)
        )
        upsert(posts, posting_table, ids("doc_id"))
    if entities is not None or gone is not None:
        with cleared(spark):
            lists = _none(spark, entity_table) if entities is None else stored_entities(
                read_lines(spark, entities, PART_FILES), in_parts
            )
            upsert(lists, entity_table, ids("entity_id"))


def _none(spark: SparkSession, table: str) -> DataFrame:
    return read_ranged(spark, table).limit(0)


def follow_entities(
    spark: SparkSession, folder: str, entity_table: str, state: str, in_parts: bool = False
) -> None:
    """Bring in the part files that ``folder`` has got since the last call.

    ``state`` is a folder that remembers which files were read, so a file is read
    once, and a call that fails is taken up where it stopped. The table is
    created by the first files. Of an id that several files have, the file that
    comes later by name counts within a call, and the later call otherwise. A list
    must stand in one file or come within one call.
    """
    _follow(spark, folder, state, lambda lines: stored_entities(lines, in_parts), entity_table, ENTITY_KEYS)


def follow_postings(spark: SparkSession, folder: str, posting_table: str, state: str) -> None:
    """As ``follow_entities``, for postings: all lines of a document come within one call."""
    _follow(spark, folder, state, stored_postings, posting_table, POSTING_KEYS)


def _follow(spark: SparkSession, folder: str, state: str, stored, table: str, keys: list[str]) -> None:
    lines = (
        spark.readStream.schema("value string")
        .option("pathGlobFilter", PART_FILES)
        .format("text")
        .load(folder)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )

    def bring_in(batch: DataFrame, number: int) -> None:
        rows = batch.select("file", F.monotonically_increasing_id().alias("pos"), "value")
        with cleared(batch.sparkSession):
            if number == 0:
                create_ranged(stored(rows), table, keys)
            else:
                upsert(stored(rows), table)

    query = (
        lines.writeStream.foreachBatch(bring_in)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
