"""Results written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.lists import ORACLE as LISTS
from catalog.lists import PART_SIZE, SQL_PARTS, shown
from catalog.search import ORACLE as SEARCHES
from catalog.search import answers
from catalog.tables import (
    SEARCH_WORDS,
    STOP_WORDS,
    customers,
    document_labels,
    document_sources,
    orders,
    sql_list,
    sql_postings,
    table,
)
from catalog.terms import index
from wordloom import schemas
from wordloom.operators import parent_child_list
from wordloom.plans import (
    build_entities,
    load_tables,
    run_queries,
    search_tables,
    write_entities,
    write_index,
)
from wordloom.scratch import cleared, new_path
from wordloom.sources import (
    query_words,
    read_entities,
    read_postings,
    read_rejects,
    read_table,
    write_delimited,
    write_entity_text,
    write_table,
)

POSTING_COLUMNS = ["word", "doc_id", "occurrences"]


def table_roundtrip(spark, sf_dir):
    path = new_path(spark, "postings")
    write_table(index(spark, sf_dir), path, ["word", "doc_id"])
    return read_table(spark, path, schemas.POSTINGS)


def text_roundtrip(spark, sf_dir, sep=" "):
    path = new_path(spark, "postings-text")
    posts = index(spark, sf_dir).where(~F.col("word").contains(sep))
    write_delimited(posts, path, POSTING_COLUMNS, sep, files=4, keys=["word", "doc_id"])
    return read_postings(spark, path, sep).select(*POSTING_COLUMNS)


def entity_text_roundtrip(spark, sf_dir):
    path = new_path(spark, "entities-text")
    entities = parent_child_list(
        customers(spark, sf_dir), orders(spark, sf_dir), part_length=PART_SIZE
    )
    write_entity_text(entities, path, files=4, in_parts=True)
    return shown(read_entities(spark, path, in_parts=True).drop("file", "pos"))


def entity_text_empty_labels(spark, sf_dir):
    """Labels that are empty or null, wherever they stand in a list, in pieces of two."""
    path = new_path(spark, "entities-text")
    children = orders(spark, sf_dir).withColumn(
        "label",
        F.when(F.col("pos") % 3 == 0, "").when(F.col("pos") % 3 == 1, F.col("label")),
    )
    entities = parent_child_list(customers(spark, sf_dir), children, part_length=2)
    write_entity_text(entities, path, in_parts=True)
    return shown(read_entities(spark, path, in_parts=True).drop("file", "pos"), "|")


def search_stored_tables(spark, sf_dir):
    posts, entities = new_path(spark, "postings"), new_path(spark, "entities")
    write_table(index(spark, sf_dir), posts, ["word", "doc_id"])
    write_table(
        build_entities(document_sources(spark, sf_dir), document_labels(spark, sf_dir)),
        entities,
        ["entity_id", "part"],
    )
    found = search_tables(
        read_table(spark, posts, schemas.POSTINGS),
        read_table(spark, entities, schemas.ENTITIES),
        query_words(spark, SEARCH_WORDS),
    )
    return answers(found)


# Lines of a file that is compressed: a scan cannot split it.
FILE_LINES = 10_000


def _files(spark, sf_dir, bad=None, compression=None):
    """The tables as text files: documents, parents, children, stop words, query words.

    ``bad`` lines are added to the documents, parents and children. ``compression`` names a
    codec for the files.
    """

    def lines(df, *fields, more=None):
        path = new_path(spark, "lines")
        rows = df.select(F.concat_ws("\t", *fields).alias("value"))
        if more is not None:
            rows = rows.unionByName(more)
        most = 0 if compression is None else FILE_LINES
        rows.write.option("maxRecordsPerFile", most).text(path, compression)
        return path

    docs = table(spark, sf_dir, "documents")
    none = F.lit("")
    labels = table(spark, sf_dir, "labels")
    return (
        lines(docs, "doc_id", F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), more=bad),
        lines(docs, "doc_id", none, "source", more=bad),
        lines(labels, "doc_id", *[none] * 7, F.col("quality").cast("string"), more=bad),
        lines(spark.createDataFrame([(w,) for w in STOP_WORDS], schemas.WORDS), "word"),
        lines(query_words(spark, SEARCH_WORDS).coalesce(1).orderBy("qid"), "word"),
    )


def _chained(spark, sf_dir, files=4, part_length=None, bad=None, rejects=None, **options):
    """From files over index, entities and tables to the answers."""
    return _run(spark, _files(spark, sf_dir, bad), files, part_length, rejects, **options)


def _run(spark, paths, files=4, part_length=None, rejects=None, compression=None, **options):
    """The programs that write and load, on files as ``_files`` gives them."""
    docs, parents, children, stop, words = paths
    index_text, entity_text, posts, entities = (
        new_path(spark, name) for name in ("index", "entities", "postings", "entity-table")
    )
    write_index(spark, docs, stop, index_text, files, rejects, compression)
    write_entities(spark, parents, children, entity_text, 4, part_length, rejects, compression)
    load_tables(
        spark, index_text, entity_text, posts, entities,
        in_parts=part_length is not None, rejects=rejects, **options,
    )
    return posts, entities, words


def programs_chained(spark, sf_dir):
    return answers(run_queries(spark, *_chained(spark, sf_dir)))


def programs_chained_raw(spark, sf_dir):
    """The index has a line for each occurrence; loading sums them."""
    return answers(run_queries(spark, *_chained(spark, sf_dir, files=0, part_length=3)))


# Every so many-th document and label has an id that is no number, every so many-th lacks fields.
BAD_IDS, SHORT = 50, 70


def _damaged(spark, sf_dir):
    """The lines of the tables once more, as malformed ones: no id, or too few fields."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(None).alias("quality"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(None).alias("source"), "quality")
    bad_id = F.concat(F.lit("x"), "doc_id", F.lit("\tno number"))
    short = F.concat(F.lit("y"), "doc_id")
    return (
        docs.unionByName(labels, allowMissingColumns=True)
        .where((F.col("doc_id") % BAD_IDS == 0) | (F.col("doc_id") % SHORT == 0))
        .select(F.when(F.col("doc_id") % BAD_IDS == 0, bad_id).otherwise(short).alias("value"))
    )


def programs_chained_rejects(spark, sf_dir):
    """Answers in spite of malformed lines."""
    rejects = new_path(spark, "rejects")
    bad = _damaged(spark, sf_dir)
    return answers(run_queries(spark, *_chained(spark, sf_dir, bad=bad, rejects=rejects)))


def programs_rejected_lines(spark, sf_dir):
    """What the programs put aside, with the reason, after two runs on the same files.

    Text is compressed. What a run writes goes before the next one, the files after the last.
    """
    rejects = new_path(spark, "rejects")
    with cleared(spark):
        paths = _files(spark, sf_dir, _damaged(spark, sf_dir), "gzip")
        for _ in range(2):
            with cleared(spark):
                _run(spark, paths, rejects=rejects, compression="gzip")
    return read_rejects(spark, rejects).withColumnRenamed("value", "line")


def loaded_tables_options(spark, sf_dir):
    """The id of a posting and the display text of an entity, as stored columns."""
    posts, entities, _ = _chained(spark, sf_dir, with_id=True, text="compat")
    found = spark.read.parquet(posts)
    named = spark.read.parquet(entities).select("entity_id", "children_text")
    return found.join(named, F.col("doc_id") == F.col("entity_id")).drop("entity_id")


QUERIES = {
    "table_roundtrip": table_roundtrip,
    "text_roundtrip": text_roundtrip,
    "entity_text_roundtrip": entity_text_roundtrip,
    "search_stored_tables": search_stored_tables,
    "programs_chained": programs_chained,
    "programs_chained_raw": programs_chained_raw,
    "programs_chained_rejects": programs_chained_rejects,
    "programs_rejected_lines": programs_rejected_lines,
    "loaded_tables_options": loaded_tables_options,
    "text_roundtrip_bar": lambda s, d: text_roundtrip(s, d, "|"),
    "entity_text_empty_labels": entity_text_empty_labels,
}

ORACLE = {
    "table_roundtrip": sql_postings(),
    "text_roundtrip": sql_postings(),
    "entity_text_roundtrip": LISTS["parent_child_list_parts"],
    "search_stored_tables": SEARCHES["search_top10"],
    "programs_chained": SEARCHES["search_top10"],
    "programs_chained_raw": f"""
        SELECT * REPLACE (CASE WHEN n_children = 0 THEN 0 ELSE part END AS part)
        FROM ({SEARCHES["search_top10"]})""",
    "programs_chained_rejects": SEARCHES["search_top10"],
    "programs_rejected_lines": f"""
        WITH bad AS (
            SELECT doc_id, doc_id % {BAD_IDS} = 0 AS no_id
            FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels)
            WHERE doc_id % {BAD_IDS} = 0 OR doc_id % {SHORT} = 0)
        SELECT 'documents' AS kind, 'bad id' AS problem, concat('x', doc_id, chr(9), 'no number') AS line
        FROM bad WHERE no_id
        UNION ALL
        SELECT kind, 'too few fields' AS problem, CASE WHEN no_id THEN concat('x', doc_id, chr(9), 'no number')
            ELSE concat('y', doc_id) END AS line
        FROM bad, (VALUES ('parents'), ('children')) k(kind)""",
    "loaded_tables_options": f"""
        SELECT word, doc_id, occurrences, concat(word, doc_id) AS id,
            CASE WHEN quality IS NULL THEN '' ELSE quality || ' ' END AS children_text
        FROM ({sql_postings()}) LEFT JOIN labels USING (doc_id)""",
    "text_roundtrip_bar": f"SELECT * FROM ({sql_postings()}) WHERE NOT contains(word, '|')",
    "entity_text_empty_labels": f"""
        SELECT c_custkey AS entity_id, c_name AS name, coalesce(part, 0) AS part,
               coalesce(n_children, 0) AS n_children, coalesce(children, '') AS children
        FROM customer LEFT JOIN (
            SELECT entity_id, rank // 2 AS part, n_children, string_agg(
                CASE WHEN pos % 3 = 1 THEN label ELSE '' END, '|' ORDER BY pos) AS children
            FROM ({SQL_PARTS}) GROUP BY ALL) ON entity_id = c_custkey""",
}
