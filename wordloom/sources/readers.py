"""Scans of text files and tables. Schemas are fixed, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordloom import schemas
from wordloom.scratch import STAGE_CODEC, new_path
from wordloom.sources.lines import (
    parse_children,
    parse_entities,
    parse_parents,
    parse_postings,
    stop_words_from_lines,
)

# Fixed value: what the data files of a job's output folder are called.
PART_FILES = "*part-*"

REJECT_COUNTS = "lines bigint, rejected bigint"

# Column order of the input: a scan numbers rows in order within one file only.
FILE_ORDER = ("file", "pos")


def read_lines(spark: SparkSession, path: str, files: str | None = None) -> DataFrame:
    """(file, pos, value), one row per line; a missing path raises.

    ``pos`` grows along each file. ``files`` is a pattern on file names.
    """
    reader = spark.read if files is None else spark.read.option("pathGlobFilter", files)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )


def strict(parsed: DataFrame) -> DataFrame:
    """Fail the job on the first malformed line.

    A record is made one value before the check, or Spark would put the parser in place of
    each column that the check names, and split a line again for each of them.
    """
    whole = parsed.select(F.inline(F.array(F.struct(*parsed.columns))))
    message = F.concat_ws(": ", F.col("problem"), F.col("value"))
    good = F.when(F.col("problem").isNotNull(), F.raise_error(message).cast("boolean"))
    return whole.where(good.otherwise(True)).drop("problem", "value")


def split_rejected(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good records, and the malformed lines with their ``problem``."""
    good = parsed.where(F.col("problem").isNull()).drop("problem", "value")
    return good, parsed.where(F.col("problem").isNotNull()).select("value", "problem")


def read_stop_words(spark: SparkSession, path: str, mode: str = "tokens") -> DataFrame:
    return stop_words_from_lines(spark.read.text(path), mode)


def read_query_words(spark: SparkSession, path: str) -> DataFrame:
    """(qid, word): one file, one word per line, as typed, in file order."""
    lines = read_lines(spark, path)
    return lines.select(F.col("pos").alias("qid"), F.col("value").alias("word"))


def query_words(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(words)), schemas.QUERY_WORDS)


def accepted(parsed: DataFrame, rejects: str | None, kind: str) -> DataFrame:
    """The good records. Malformed lines fail the job or, with a path, are put aside there.

    The lines are read and parsed once: records are staged in the shared folder with
    the reason of their rejection, good ones without the line, and read from there. They
    stay in the order they come in, so that staging sorts nothing; files without a
    rejected line are passed over by the statistics of their ``problem``.
    ``rejects`` gets the bad lines, and how many lines there were, each in a folder for ``kind``,
    which replaces what an earlier run left. ``read_rejects`` reads them.
    """
    if rejects is None:
        return strict(parsed)
    spark = parsed.sparkSession
    stage = new_path(spark, "parsed")
    bad = F.col("problem").isNotNull()
    seen = Observation()
    rows = parsed.withColumn("value", F.when(bad, F.col("value"))).observe(
        seen, F.count("*").alias("lines"), F.count("problem").alias("rejected")
    )
    rows.write.parquet(stage, compression=STAGE_CODEC)
    staged = spark.read.schema(parsed.schema).parquet(stage)
    staged.where(bad).select(F.concat_ws("\t", "problem", "value").alias("value")).write.mode(
        "overwrite"
    ).text(f"{rejects}/lines/kind={kind}")
    counts = spark.createDataFrame([(seen.get["lines"], seen.get["rejected"])], REJECT_COUNTS)
    counts.coalesce(1).write.mode("overwrite").json(f"{rejects}/counts/kind={kind}")
    return staged.where(~bad).select(*[c for c in parsed.columns if c not in ("problem", "value")])


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    """(kind, problem, value): the lines put aside by the last run of each kind of reader."""
    lines = spark.read.schema("value string, kind string").text(f"{rejects}/lines")
    parts = F.split("value", "\t", 2)
    return lines.select("kind", F.get(parts, 0).alias("problem"), F.get(parts, 1).alias("value"))


def reject_counts(spark: SparkSession, rejects: str) -> DataFrame:
    """(kind, lines, rejected) of the last run of each kind of reader."""
    counts = spark.read.schema(f"{REJECT_COUNTS}, kind string").json(f"{rejects}/counts")
    return counts.select("kind", "lines", "rejected")


def read_parents(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    return accepted(parse_parents(read_lines(spark, path)), rejects, "parents")


def read_children(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    return accepted(parse_children(read_lines(spark, path)), rejects, "children")


def read_postings(
    spark: SparkSession,
    path: str,
    sep: str = " ",
    rejects: str | None = None,
    placed: bool = True,
) -> DataFrame:
    """(file, pos, word, doc_id, occurrences), without file and pos if not ``placed``."""
    if placed:
        lines = read_lines(spark, path, PART_FILES)
    else:
        lines = spark.read.option("pathGlobFilter", PART_FILES).text(path)
    return accepted(parse_postings(lines, sep), rejects, "postings")


def read_entities(
    spark: SparkSession, path: str, in_parts: bool = False, rejects: str | None = None
) -> DataFrame:
    lines = read_lines(spark, path, PART_FILES)
    return accepted(parse_entities(lines, in_parts), rejects, "entities")


def read_table(
    spark: SparkSession, table: str, schema: str, partitions: int | None = None
) -> DataFrame:
    """A stored table by name, or a Parquet folder by path (anything with a slash).

    ``partitions`` deals the rows anew, for a table in one row group, which a
    scan cannot split. It is up to the caller, whatever the size.
    """
    rows = spark.read.schema(schema).parquet(table) if "/" in table else spark.table(table)
    return rows.repartition(partitions) if partitions else rows

