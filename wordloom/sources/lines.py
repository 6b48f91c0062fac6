"""Lines of text to records.

The ``parse_*`` functions take lines as ``value`` and keep all other columns.
They never fail: a malformed line has its reason in ``problem``, which is null
for a good one. ``strict`` and ``split_rejected`` act on that column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import clean, label_with_fallback, tokenize
from wordloom.functions.fields import lenient_bigint, strict_bigint
from wordloom.functions.text import DELIMITER_CHARS

# Where the fields of a record stand.
PARENT_ID, PARENT_NAME = 0, 2
CHILD_ID, CHILD_LABEL, CHILD_FALLBACK = 0, 8, 9


def stop_words_from_lines(lines: DataFrame, mode: str) -> DataFrame:
    """Distinct entries, as written. ``tokens``: several words to a line, parted
    by blanks. ``lines``: each whole line is one entry, blanks included."""
    if mode == "lines":
        return lines.select(F.col("value").alias("word")).distinct()
    if mode == "tokens":
        words = lines.select(F.explode(tokenize(F.col("value"))).alias("word"))
        return words.where(F.col("word") != "").distinct()
    raise ValueError(f"mode must be 'tokens' or 'lines', not {mode!r}")


def tokens_from_lines(lines: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(doc_id, word), one row per token of lines that begin with the id.

    Cleaning comes before the id is cut off. A line with no other token than
    the id gives no row. With ``id_type="string"`` an id need not be a number.
    """
    rows = words_from_lines(lines, id_type)
    return rows.select("doc_id", F.explode("words").alias("word")).where(F.col("word") != "")


def words_from_lines(lines: DataFrame, id_type: str = "bigint") -> DataFrame:
    """(doc_id, words), one row per line: the array of what ``tokens_from_lines`` gives rows
    of, in which empty words do not count."""
    words = tokenize(F.ltrim(clean(F.col("value")), F.lit(DELIMITER_CHARS)))
    doc_id = F.col("_words")[0]
    return (
        lines.select(words.alias("_words"))
        .where(F.size("_words") > 1)
        .select(
            (strict_bigint(doc_id) if id_type == "bigint" else doc_id).alias("doc_id"),
            F.slice("_words", 2, F.size("_words")).alias("words"),
        )
    )


def parse_documents(lines: DataFrame) -> DataFrame:
    """(doc_id, text): the id is the first token of the cleaned line, the rest is text.

    Blank lines, and lines with nothing but the id, give no row and are no fault.
    """
    cleaned = F.ltrim(clean(F.col("value")), F.lit(DELIMITER_CHARS))
    rows = lines.withColumn("_words", F.split(cleaned, f"[{DELIMITER_CHARS}]+", 2))
    rows = rows.where(F.length(F.trim(F.get("_words", 1))) > 0)
    rows = rows.withColumns(
        {"doc_id": lenient_bigint(F.get("_words", 0)), "text": F.get("_words", 1)}
    )
    return _parsed(rows, lines, ["doc_id", "text"], (F.col("doc_id").isNull(), "bad id"))


def parse_parents(lines: DataFrame) -> DataFrame:
    """(entity_id, name): tab-separated, everything but two fields ignored."""
    fields = F.col("_fields")
    rows = lines.withColumn("_fields", _fields(F.col("value"), "\t")).withColumn(
        "entity_id", lenient_bigint(F.get(fields, PARENT_ID))
    )
    return _parsed(
        rows.withColumn("name", F.get(fields, PARENT_NAME)),
        lines,
        ["entity_id", "name"],
        (F.size(fields) <= PARENT_NAME, "too few fields"),
        (F.col("entity_id").isNull(), "bad id"),
    )


def parse_children(lines: DataFrame) -> DataFrame:
    """(entity_id, label): tab-separated, the label with its fallback field."""
    fields = F.col("_fields")
    label, fallback = F.get(fields, CHILD_LABEL), F.get(fields, CHILD_FALLBACK)
    rows = lines.withColumn("_fields", _fields(F.col("value"), "\t")).withColumns(
        {
            "entity_id": lenient_bigint(F.get(fields, CHILD_ID)),
            "label": label_with_fallback(label, fallback),
        }
    )
    # A label without its fallback field is null.
    return _parsed(
        rows,
        lines,
        ["entity_id", "label"],
        (F.size(fields) <= CHILD_LABEL, "too few fields"),
        (F.col("label").isNull(), "no fallback label"),
        (F.col("entity_id").isNull(), "bad id"),
    )


def parse_postings(lines: DataFrame, sep: str = " ") -> DataFrame:
    """(word, doc_id, occurrences)"""
    fields = F.col("_fields")
    rows = lines.withColumn("_fields", _fields(F.col("value"), sep)).withColumns(
        {
            "word": F.get(fields, 0),
            "doc_id": lenient_bigint(F.get(fields, 1)),
            "occurrences": lenient_bigint(F.get(fields, 2)),
        }
    )
    return _parsed(
        rows,
        lines,
        ["word", "doc_id", "occurrences"],
        (F.size(fields) < 3, "too few fields"),
        (F.col("doc_id").isNull(), "bad id"),
        (F.col("occurrences").isNull(), "bad count"),
    )


def parse_entities(lines: DataFrame, in_parts: bool = False) -> DataFrame:
    """(entity_id, name, part, n_children, children): any number of children.

    A whole list stands on one line, ``id, name, child...``, of which empty
    fields at the end are dropped. With ``in_parts`` each line is a piece, ``id,
    part, n_children, name, child...``, and nothing is dropped.
    """
    plain = F.split("value", "\t")
    if in_parts:
        rows = lines.withColumn("_fields", plain).withColumns(
            {
                "entity_id": lenient_bigint(F.get("_fields", 0)),
                "part": lenient_bigint(F.get("_fields", 1)),
                "n_children": lenient_bigint(F.get("_fields", 2)),
                "name": F.get("_fields", 3),
                # A parent without children has no field behind the name.
                "children": F.slice("_fields", 5, F.greatest(F.size("_fields"), F.lit(1))),
            }
        )
        least = 4
    else:
        rows = lines.withColumn("_fields", plain).withColumns(
            {
                "entity_id": lenient_bigint(F.get("_fields", 0)),
                "name": F.get("_fields", 1),
                "part": F.lit(0).cast("bigint"),
                "children": F.slice(_fields(F.col("value"), "\t"), 3, F.size("_fields")),
            }
        )
        rows = rows.withColumn("n_children", F.size("children").cast("bigint"))
        least = 2
    bad = F.col("entity_id").isNull() | F.col("part").isNull() | F.col("n_children").isNull()
    return _parsed(
        rows,
        lines,
        ["entity_id", "name", "part", "n_children", "children"],
        (F.size("_fields") < least, "too few fields"),
        (bad, "bad id"),
    )


def _parsed(
    rows: DataFrame, lines: DataFrame, columns: list[str], *checks: tuple[Column, str]
) -> DataFrame:
    """The columns, with the first reason whose check is true as ``problem``."""
    kept = [c for c in lines.columns if c != "value"]
    problem = F.coalesce(*[F.when(bad, F.lit(reason)) for bad, reason in checks])
    return rows.select(*kept, *columns, problem.alias("problem"), "value")


def _fields(line: Column, sep: str) -> Column:
    """Split at ``sep`` as it is, without the empty fields at the end of the line.

    A single character is given as a pattern that is no regular expression to Java, so
    that none is compiled for each line; only lines that end with it are trimmed.
    """
    quoted = "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    trimmed = F.when(line.endswith(sep), F.regexp_replace(line, f"({quoted})+\\z", "")).otherwise(line)
    if len(sep) > 1:
        return F.split(trimmed, quoted)
    return F.split(trimmed, f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep)
