from wordloom.plans.impact import search_by_impact, top_by_impact, write_impact_index
from wordloom.plans.index import build_entities, build_index, corpus_tokens
from wordloom.plans.programs import (
    count_corpus,
    load_tables,
    rank_corpus_terms,
    run_queries,
    write_entities,
    write_index,
)
from wordloom.plans.search import (
    search_bucketed,
    search_documents,
    search_tables,
    search_word,
)
from wordloom.plans.updates import (
    create_updatable,
    follow_entities,
    follow_postings,
    update_tables,
)

__all__ = [
    "build_entities",
    "build_index",
    "corpus_tokens",
    "count_corpus",
    "create_updatable",
    "follow_entities",
    "follow_postings",
    "load_tables",
    "rank_corpus_terms",
    "run_queries",
    "search_bucketed",
    "search_by_impact",
    "search_documents",
    "search_tables",
    "search_word",
    "top_by_impact",
    "update_tables",
    "write_entities",
    "write_impact_index",
    "write_index",
]
