from wordloom.operators.bitmaps import filter_by_bitmaps
from wordloom.operators.blocks import code_blocks, decode_blocks, postings_between, postings_from
from wordloom.operators.counts import corpus_total, rank_terms, term_counts
from wordloom.operators.dictionary import numbered_postings, term_dictionary, with_words
from wordloom.operators.enrich import (
    child_rows,
    last_per_key,
    parent_child_list,
    parents_only,
    restrict_to,
)
from wordloom.operators.heavy import heavy_keys, split_join
from wordloom.operators.index import (
    counted_rows,
    last_posting_per_word,
    postings,
    raw_postings,
    row_postings,
    summed_in_order,
    summed_postings,
)
from wordloom.operators.topk import (
    best_of_word,
    few_hits,
    match_words,
    search,
    top_per_key,
    top_postings,
)
from wordloom.operators.words import WordSet, drop_stop_words, keep_query_words, tokens, word_set

__all__ = [
    "WordSet",
    "best_of_word",
    "child_rows",
    "code_blocks",
    "corpus_total",
    "counted_rows",
    "decode_blocks",
    "drop_stop_words",
    "few_hits",
    "filter_by_bitmaps",
    "heavy_keys",
    "keep_query_words",
    "last_per_key",
    "last_posting_per_word",
    "match_words",
    "numbered_postings",
    "parent_child_list",
    "parents_only",
    "postings",
    "postings_between",
    "postings_from",
    "rank_terms",
    "raw_postings",
    "restrict_to",
    "row_postings",
    "search",
    "split_join",
    "summed_in_order",
    "summed_postings",
    "term_counts",
    "term_dictionary",
    "tokens",
    "top_per_key",
    "top_postings",
    "with_words",
    "word_set",
]
