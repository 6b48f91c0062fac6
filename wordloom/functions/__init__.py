from wordloom.functions.fields import label_with_fallback, strict_bigint
from wordloom.functions.render import (
    children_text,
    children_text_compat,
    entity_line,
    entity_part_line,
    plain_quotes,
    posting_line,
    posting_value,
    surrogate_key,
)
from wordloom.functions.text import clean, tokenize

__all__ = [
    "children_text",
    "children_text_compat",
    "clean",
    "entity_line",
    "entity_part_line",
    "label_with_fallback",
    "plain_quotes",
    "posting_line",
    "posting_value",
    "strict_bigint",
    "surrogate_key",
    "tokenize",
]
