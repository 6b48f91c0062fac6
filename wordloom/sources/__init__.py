from wordloom.sources.buckets import write_bucketed
from wordloom.sources.lines import (
    parse_children,
    parse_documents,
    parse_entities,
    parse_parents,
    parse_postings,
    stop_words_from_lines,
    tokens_from_lines,
    words_from_lines,
)
from wordloom.sources.readers import (
    query_words,
    read_children,
    read_entities,
    read_lines,
    read_parents,
    read_postings,
    read_query_words,
    read_rejects,
    read_stop_words,
    read_table,
    reject_counts,
    split_rejected,
    strict,
)
from wordloom.sources.upsert import create_ranged, read_ranged, upsert
from wordloom.sources.writers import write_delimited, write_entity_text, write_table

__all__ = [
    "create_ranged",
    "parse_children",
    "parse_documents",
    "parse_entities",
    "parse_parents",
    "parse_postings",
    "query_words",
    "read_children",
    "read_entities",
    "read_lines",
    "read_parents",
    "read_postings",
    "read_query_words",
    "read_ranged",
    "read_rejects",
    "read_stop_words",
    "read_table",
    "reject_counts",
    "split_rejected",
    "stop_words_from_lines",
    "strict",
    "tokens_from_lines",
    "words_from_lines",
    "upsert",
    "write_bucketed",
    "write_delimited",
    "write_entity_text",
    "write_table",
]
