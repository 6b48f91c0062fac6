"""Sinks. All of them replace what was at the target."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from wordloom.functions import entity_line, entity_part_line
from wordloom.scratch import new_path, remove, shuffles_freed

# Bytes of a staged file, as stored, and rows that one task sorts at most about; shuffled, both
# are several times as wide.
FILE_BYTES = 128 * 1024 * 1024
FILE_ROWS = 4_000_000


def write_delimited(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    sep: str = "\t",
    files: int | None = None,
    keys: Sequence[str] = (),
    combine: Callable[[DataFrame], DataFrame] | None = None,
    staged: bool = False,
    compression: str | None = None,
) -> None:
    """One line per row. ``files`` sets the number of files, see ``_write_lines``, and ``combine``
    makes one row of those with equal keys, as in ``write_table``; ``staged`` is as there, too.
    ``compression`` names a codec for the files, such as gzip, which Spark's readers tell by their
    names.

    Null is written as an empty field. A separator or line end within a field
    fails the job, since the line could not be read back.
    """
    kinds = {c: df.schema[c].dataType for c in columns}
    fields = []
    for c in columns:
        field = F.coalesce(F.col(c).cast("string"), F.lit(""))
        # A whole number has no other characters than these.
        plain = isinstance(kinds[c], IntegralType) and not set(sep) & set("-0123456789")
        fields.append(field if plain else safe_field(field, sep))
    _write_lines(df, path, F.concat_ws(sep, *fields), files, keys, combine, staged, compression)


def write_entity_text(
    entities: DataFrame,
    path: str,
    files: int | None = None,
    in_parts: bool = False,
    compression: str | None = None,
) -> None:
    """``id, name, child...``, or with ``in_parts`` the form of ``entity_part_line``;
    ``compression`` as in ``write_delimited``.

    Null names and children are written as empty fields; a tab or line end in
    one fails the job. Lists that are cut need ``in_parts``.
    """
    name = safe_field(F.col("name"), "\t")
    children = F.transform("children", lambda c: safe_field(c, "\t"))
    if in_parts:
        numbers = [F.col(c) for c in ("part", "n_children")]
        line = entity_part_line(F.col("entity_id"), name, *numbers, children)
    else:
        cut = F.raise_error(F.lit("a list in parts needs in_parts=True")).cast("string")
        line = F.when(F.col("n_children") > F.size("children"), cut).otherwise(
            entity_line(F.col("entity_id"), name, children)
        )
    _write_lines(entities, path, line, files, ["entity_id", "part"], compression=compression)


def safe_field(field: Column, sep: str) -> Column:
    """The field, or an error if it holds the separator or a line end."""
    bad = field.contains(sep) | field.contains("\n") | field.contains("\r")
    message = F.concat(F.lit("separator or line end in field: "), field)
    return F.when(bad, F.raise_error(message).cast("string")).otherwise(field)


def write_table(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    files: int | None = None,
    file_bytes: int = FILE_BYTES,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    staged: bool = False,
) -> None:
    """A table by name, or a Parquet folder by path (anything with a slash).

    Files hold key ranges and are sorted, so a filter on the first key skips
    most of them; a key with very many rows is cut by the keys after it. There
    are ``files`` of them, but more where one would hold more than about ``file_bytes``
    or ``FILE_ROWS``, so that the rows that a task sorts do not grow with the table.

    ``combine`` makes one row of those with equal ``keys``. It gets them dealt to the
    ranges, so that grouping by all the keys needs no exchange of its own.

    ``staged`` tells that the rows are read from files in the shared folder already, and need
    not be staged there once more.
    """
    with _in_ranges(df, keys, files, file_bytes, combine, staged) as rows:
        writer = rows.write.mode("overwrite")
        if "/" in table:
            writer.parquet(table)
        else:
            writer.saveAsTable(table)


@contextmanager
def _in_ranges(
    df: DataFrame,
    keys: Sequence[str],
    files: int | None,
    file_bytes: int = FILE_BYTES,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    staged: bool = False,
) -> Iterator[DataFrame]:
    """The rows in sorted key ranges, at least ``files``, which bytes and rows may raise.

    Ranges need a sample. The rows are first kept in the shared folder, unless they are
    ``staged``, so that what made them runs once and the sample reads only the keys of a
    stored table. The files that are shuffled go as soon as the ranges are written.
    """
    spark = df.sparkSession
    stage = new_path(spark, "stage")
    with shuffles_freed(spark):
        try:
            rows = df
            if not staged:
                df.write.parquet(stage)
                rows = spark.read.schema(df.schema).parquet(stage)
            folders = {file.rpartition("/")[0] for file in rows.inputFiles()}
            size = sum(_stored_bytes(df, folder) for folder in folders)
            ranges = max(files or 1, -(-size // file_bytes), -(-rows.count() // FILE_ROWS))
            ranged = rows.repartitionByRange(ranges, *keys)
            yield (combine(ranged) if combine else ranged).sortWithinPartitions(*keys)
        finally:
            remove(spark, stage)


def _stored_bytes(df: DataFrame, path: str) -> int:
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(conf).getContentSummary(folder).getLength()


def _write_lines(
    df: DataFrame,
    path: str,
    line: Column,
    files: int | None,
    keys: Sequence[str],
    combine: Callable[[DataFrame], DataFrame] | None = None,
    staged: bool = False,
    compression: str | None = None,
) -> None:
    """``files`` files, each sorted by the keys, or more as in ``write_table``; 0 or None writes
    rows as they come."""
    if not files:
        if combine is not None:
            df = combine(df)
        df.select(line.alias("value")).write.mode("overwrite").text(path, compression)
        return
    with _in_ranges(df, keys, files, combine=combine, staged=staged) as rows:
        rows.select(line.alias("value")).write.mode("overwrite").text(path, compression)
