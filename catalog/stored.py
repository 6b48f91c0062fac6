"""Stored indexes and tables: impact order, updates, buckets, coded lists, term ids."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.lists import ORDERS, shown
from catalog.lists import ORACLE as LISTS
from catalog.search import ORACLE as SEARCHES
from catalog.search import SQL_DOCUMENT_ENTITIES, answers, sql_search
from catalog.tables import (
    SEARCH_WORDS,
    STOP_WORDS,
    customers,
    document_labels,
    document_sources,
    documents,
    orders,
    sql_kept,
    sql_postings,
    sql_tokens,
    table,
)
from catalog.terms import index
from wordloom import schemas
from wordloom.operators import (
    code_blocks,
    decode_blocks,
    filter_by_bitmaps,
    heavy_keys,
    numbered_postings,
    parent_child_list,
    postings_from,
    split_join,
    term_dictionary,
    tokens,
    top_per_key,
    with_words,
)
from wordloom.plans import (
    build_entities,
    follow_entities,
    load_tables,
    search_bucketed,
    search_by_impact,
    search_documents,
    write_impact_index,
)
from wordloom.scratch import new_path
from wordloom.sources import (
    create_ranged,
    query_words,
    read_ranged,
    read_table,
    stop_words_from_lines,
    upsert,
    write_bucketed,
    write_delimited,
    write_entity_text,
)

BUCKETS = 8
PART_SIZE = 3
GONE, CHANGED, RARE = 11, 7, 100


def search_impact_order(spark, sf_dir):
    found = write_impact_index(index(spark, sf_dir), new_path(spark, "impact-index"), block=16)
    entities = build_entities(document_sources(spark, sf_dir), document_labels(spark, sf_dir))
    return answers(search_by_impact(found, entities, query_words(spark, SEARCH_WORDS)))


def search_impact_sparse(spark, sf_dir):
    """Few documents are entities, so many blocks must be read."""
    found = write_impact_index(index(spark, sf_dir), new_path(spark, "impact-index"), block=4)
    entities = build_entities(
        document_sources(spark, sf_dir).where(F.col("entity_id") % RARE == 0),
        document_labels(spark, sf_dir),
    )
    return answers(search_by_impact(found, entities, query_words(spark, SEARCH_WORDS)))


def _changed_lists(spark, sf_dir, path):
    """Lists in parts; then shorter ones for some customers, and some customers gone."""
    parents, children = customers(spark, sf_dir), orders(spark, sf_dir)
    whole = build_entities(parents, children, part_length=PART_SIZE)
    create_ranged(whole, path, ["entity_id", "part"], ranges=6)
    some = F.col("entity_id") % CHANGED == 0
    shorter = build_entities(
        parents.where(some).withColumn("name", F.concat("name", F.lit("'"))),
        children.where(some & (F.col("pos") % 2 == 0)),
        part_length=PART_SIZE + 1,
    )
    gone = parents.where(F.col("entity_id") % GONE == 0).select("entity_id")
    return shorter, gone


def table_upsert(spark, sf_dir):
    path = new_path(spark, "ranged")
    shorter, gone = _changed_lists(spark, sf_dir, path)
    upsert(shorter.where(F.col("entity_id") % GONE != 0), path, gone)
    return shown(read_ranged(spark, path))


def entity_parts_replaced(spark, sf_dir):
    """Text with an old and a new list in pieces for some ids; the new one counts whole."""
    lines, index_lines, posts, entities = (
        new_path(spark, name) for name in ("entity-lines", "no-index", "posts", "entities")
    )
    parents, children = customers(spark, sf_dir), orders(spark, sf_dir)
    old = parent_child_list(parents, children, part_length=PART_SIZE)
    some = F.col("entity_id") % CHANGED == 0
    new = parent_child_list(
        parents.where(some), children.where(some & (F.col("pos") % 2 == 0)), part_length=PART_SIZE + 1
    )
    write_entity_text(old, f"{lines}/1", in_parts=True)
    write_entity_text(new, f"{lines}/2", in_parts=True)
    write_delimited(index(spark, sf_dir), index_lines, ["word", "doc_id", "occurrences"], " ")
    load_tables(spark, index_lines, f"{lines}/*", posts, entities, in_parts=True)
    return shown(read_table(spark, entities, schemas.ENTITIES))


def incremental_loads(spark, sf_dir):
    """A folder of entity lines that grows: every load reads the files it has not read."""
    folder, state, path = (new_path(spark, name) for name in ("growing", "state", "followed"))
    parents, children = customers(spark, sf_dir), orders(spark, sf_dir)
    for step in range(3):
        some = F.col("entity_id") % 3 == step
        lists = parent_child_list(parents.where(some), children.where(some), part_length=PART_SIZE)
        write_entity_text(lists, f"{folder}/{step}", in_parts=True)
        follow_entities(spark, f"{folder}/*", path, state, in_parts=True)
    return shown(read_ranged(spark, path).drop("generation"))


def _bucketed(spark, df, key, sort=()):
    name = f"wordloom_{uuid.uuid4().hex}"
    write_bucketed(df, name, key, BUCKETS, sort, new_path(spark, "bucketed"))
    return spark.table(name)


def search_stored_buckets(spark, sf_dir):
    posts = _bucketed(spark, index(spark, sf_dir), "doc_id", ["word"])
    entities = build_entities(document_sources(spark, sf_dir), document_labels(spark, sf_dir))
    entities = _bucketed(spark, entities, "entity_id", ["part"])
    return answers(search_bucketed(posts, entities, query_words(spark, SEARCH_WORDS)))


def lists_bucketed(spark, sf_dir):
    parents = _bucketed(spark, customers(spark, sf_dir), "entity_id")
    children = _bucketed(spark, orders(spark, sf_dir), "entity_id", ["pos"])
    return shown(parent_child_list(parents, children))


def _by_bitmap(how):
    def query(spark, sf_dir):
        lines = table(spark, sf_dir, "benchmark").select(F.col("text").alias("value"))
        words = stop_words_from_lines(lines, "tokens")
        return filter_by_bitmaps(tokens(documents(spark, sf_dir)), words, words.count(), how)

    return query


def postings_by_term_id(spark, sf_dir):
    path = new_path(spark, "postings")  # read for the dictionary, for heavy words and for the numbers
    index(spark, sf_dir).write.parquet(path)
    posts = read_table(spark, path, schemas.POSTINGS)
    terms = term_dictionary(posts)
    return with_words(numbered_postings(posts, terms), terms)


def postings_blocks(spark, sf_dir):
    path = new_path(spark, "blocks")
    code_blocks(index(spark, sf_dir)).write.parquet(path)
    return decode_blocks(spark.read.parquet(path))


def block_heads(spark, sf_dir):
    """What tells a reader which blocks it may pass over."""
    return code_blocks(index(spark, sf_dir), block=32).drop("gaps", "counts")


def postings_frequent(spark, sf_dir):
    blocks = code_blocks(index(spark, sf_dir))
    return postings_from(blocks, SEARCH_WORDS[0], 3)


def search_heavy_word(spark, sf_dir):
    """Every document asks the same word, and every tenth one another: one key has most rows."""
    posts = index(spark, sf_dir).where(F.col("word").isin(SEARCH_WORDS))
    top = top_per_key(posts, "word", [F.desc("occurrences"), F.asc("doc_id")], 10, ["doc_id"])
    qid = F.col("doc_id")
    words = documents(spark, sf_dir).select(
        qid.alias("qid"),
        F.when(qid % 10 == 0, SEARCH_WORDS[1]).otherwise(SEARCH_WORDS[0]).alias("word"),
    )
    heavy = heavy_keys(words, "word", least=100)
    return split_join(words, top, "word", "inner", ["qid"], heavy).select(
        "qid", "word", "rank", "doc_id", "occurrences"
    )


def search_heavy_answers(spark, sf_dir):
    """As above, with names and lists: ten documents are in nearly all answers."""
    qid = F.col("doc_id")
    words = documents(spark, sf_dir).select(
        qid.alias("qid"),
        F.when(qid % 10 == 0, SEARCH_WORDS[1]).otherwise(SEARCH_WORDS[0]).alias("word"),
    )
    sides = document_sources(spark, sf_dir), document_labels(spark, sf_dir)
    found = search_documents(
        documents(spark, sf_dir), *sides, words, STOP_WORDS, few=False, heavy_rows=100
    )
    return answers(found)


QUERIES = {
    "search_impact_order": search_impact_order,
    "search_impact_sparse": search_impact_sparse,
    "table_upsert": table_upsert,
    "entity_parts_replaced": entity_parts_replaced,
    "incremental_loads": incremental_loads,
    "search_bucketed": search_stored_buckets,
    "lists_bucketed": lists_bucketed,
    "tokens_kept_bitmap": _by_bitmap("left_anti"),
    "tokens_of_list_bitmap": _by_bitmap("left_semi"),
    "term_dictionary": lambda s, d: term_dictionary(index(s, d)),
    "postings_by_term_id": postings_by_term_id,
    "postings_blocks": postings_blocks,
    "postings_block_heads": block_heads,
    "postings_frequent": postings_frequent,
    "search_heavy_word": search_heavy_word,
    "search_heavy_answers": search_heavy_answers,
}


def sql_cut(children: str, length: int, quote: str = "") -> str:
    """Lists in parts of so many children, with the name and its quotes."""
    return f"""
        SELECT c_custkey AS entity_id, c_name || '{quote * 2}' AS name, coalesce(part, 0) AS part,
               coalesce(n_children, 0) AS n_children, coalesce(children, '') AS children
        FROM customer LEFT JOIN (
            SELECT entity_id, rank // {length} AS part, n_children,
                   string_agg(label, ', ' ORDER BY pos) AS children
            FROM (SELECT entity_id, label, pos, count(*) OVER (PARTITION BY entity_id) AS n_children,
                         row_number() OVER (PARTITION BY entity_id ORDER BY pos) - 1 AS rank
                  FROM ({children})) GROUP BY ALL) ON entity_id = c_custkey"""


EVEN = f"SELECT * FROM ({ORDERS}) WHERE pos % 2 = 0"
BENCHMARK_WORDS = r"""
    SELECT DISTINCT unnest(string_split_regex(text, '[ \t\n\r\f]+')) AS word FROM benchmark"""
SQL_TERMS = f"""
    SELECT row_number() OVER (ORDER BY word) - 1 AS term_id, word
    FROM (SELECT DISTINCT word FROM ({sql_kept()}))"""

ORACLE = {
    "search_impact_order": SEARCHES["search_top10"],
    "search_impact_sparse": sql_search(
        "SELECT CAST(i AS BIGINT) AS qid, word FROM (SELECT unnest(range({0})) AS i, unnest([{1}]) AS word)".format(
            len(SEARCH_WORDS), ", ".join("'" + w.replace("'", "''") + "'" for w in SEARCH_WORDS)
        ),
        sql_postings(),
        f"SELECT * FROM ({SQL_DOCUMENT_ENTITIES}) WHERE entity_id % {RARE} = 0",
    ),
    "table_upsert": f"""
        SELECT *, CAST(1 AS BIGINT) AS generation FROM ({sql_cut(ORDERS, PART_SIZE)})
        WHERE entity_id % {CHANGED} <> 0 AND entity_id % {GONE} <> 0
        UNION ALL
        SELECT *, CAST(2 AS BIGINT) AS generation FROM ({sql_cut(EVEN, PART_SIZE + 1, "'")})
        WHERE entity_id % {CHANGED} = 0 AND entity_id % {GONE} <> 0""",
    "entity_parts_replaced": f"""
        SELECT * FROM ({sql_cut(ORDERS, PART_SIZE)}) WHERE entity_id % {CHANGED} <> 0
        UNION ALL
        SELECT * FROM ({sql_cut(EVEN, PART_SIZE + 1)}) WHERE entity_id % {CHANGED} = 0""",
    "incremental_loads": sql_cut(ORDERS, PART_SIZE),
    "search_bucketed": SEARCHES["search_top10"],
    "lists_bucketed": LISTS["parent_child_list"],
    "tokens_kept_bitmap": f"""
        SELECT doc_id, word FROM ({sql_tokens()}) t ANTI JOIN ({BENCHMARK_WORDS}) s USING (word)""",
    "tokens_of_list_bitmap": f"""
        SELECT doc_id, word FROM ({sql_tokens()}) t SEMI JOIN ({BENCHMARK_WORDS}) s USING (word)""",
    "term_dictionary": SQL_TERMS,
    "postings_by_term_id": f"""
        SELECT word, term_id, doc_id, occurrences FROM ({sql_postings()}) JOIN ({SQL_TERMS}) USING (word)""",
    "postings_blocks": sql_postings(),
    "postings_block_heads": f"""
        SELECT word, (rank // 32)::BIGINT AS block, count(*)::INTEGER AS n, min(doc_id) AS min_doc,
            max(doc_id) AS max_doc, max(occurrences) AS max_occurrences
        FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY doc_id) - 1 AS rank
              FROM ({sql_postings()})) GROUP BY ALL""",
    "postings_frequent": f"""
        SELECT * FROM ({sql_postings()}) WHERE word = '{SEARCH_WORDS[0]}' AND occurrences >= 3""",
    "search_heavy_answers": sql_search(
        f"""SELECT doc_id AS qid, CASE WHEN doc_id % 10 = 0 THEN '{SEARCH_WORDS[1]}'
            ELSE '{SEARCH_WORDS[0]}' END AS word FROM documents""",
        sql_postings(),
        SQL_DOCUMENT_ENTITIES,
    ),
    "search_heavy_word": f"""
        SELECT d.doc_id AS qid, word, CAST(rank AS INTEGER) AS rank, t.doc_id, occurrences
        FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '{SEARCH_WORDS[1]}'
                     ELSE '{SEARCH_WORDS[0]}' END AS word FROM documents) d
        JOIN (SELECT *, row_number() OVER (PARTITION BY word ORDER BY occurrences DESC, doc_id) AS rank
              FROM ({sql_postings()})) t USING (word)
        WHERE rank <= 10""",
}
