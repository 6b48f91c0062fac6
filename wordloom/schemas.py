"""The schemas the operators exchange, as DDL."""

DOCUMENTS = "doc_id BIGINT, text STRING"
WORDS = "word STRING"
QUERY_WORDS = "qid BIGINT, word STRING"
TERM_COUNTS = "word STRING, occurrences BIGINT"
POSTINGS = "word STRING, doc_id BIGINT, occurrences BIGINT"
PARENTS = "entity_id BIGINT, name STRING, pos BIGINT"
CHILDREN = "entity_id BIGINT, label STRING, pos BIGINT"
ENTITIES = (
    "entity_id BIGINT, name STRING, part BIGINT, n_children BIGINT, children ARRAY<STRING>"
)
