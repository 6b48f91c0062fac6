"""Display text and text-file lines for postings and entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(word: Column, doc_id: Column) -> Column:
    """Word and id without a separator. Not unique: use (word, doc_id) as key."""
    return F.concat(word, doc_id.cast("string"))


def posting_value(doc_id: Column, occurrences: Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, doc_id.cast("string"), occurrences.cast("string"))


def posting_line(word: Column, doc_id: Column, occurrences: Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, word, doc_id.cast("string"), occurrences.cast("string"))


def entity_line(entity_id: Column, name: Column, children: Column) -> Column:
    """``id, name, child, child...``; a childless line ends with a tab. Null is empty."""
    return F.concat_ws(
        "\t", entity_id.cast("string"), F.coalesce(name, F.lit("")), F.array_join(children, "\t", "")
    )


def entity_part_line(
    entity_id: Column, name: Column, part: Column, n_children: Column, children: Column
) -> Column:
    """``id, part, n_children, name, child...``, with as many fields as there are children."""
    numbers = F.array(*[x.cast("string") for x in (entity_id, part, n_children)])
    fields = F.concat(numbers, F.array(name.cast("string")), children)
    return F.array_join(fields, "\t", "")


def plain_quotes(text: Column) -> Column:
    return F.translate(text, '"', "'")


def children_text(children: Column) -> Column:
    return F.array_join(children, " ")


def children_text_compat(
    children: Column, n_children: Column | None = None, first: Column | None = None
) -> Column:
    """A blank after every child except the second to last.

    Where a list is stored in several parts, ``n_children`` is the length of
    the whole list and ``first`` the place of this part's first child in it, so
    that the texts of the parts, put together, are the text of the whole list.
    """
    n_children = F.size(children) if n_children is None else n_children
    first = F.lit(0) if first is None else first
    pieces = F.transform(
        children,
        lambda child, i: F.when(first + i == n_children - 2, child).otherwise(
            F.concat(child, F.lit(" "))
        ),
    )
    return F.array_join(pieces, "")
