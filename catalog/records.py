"""Records parsed from delimited text, which is made from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (
    STOP_WORDS,
    document_labels,
    document_sources,
    documents,
    sql_kept,
    sql_postings,
    table,
)
from catalog.terms import index
from wordloom.functions import entity_line, label_with_fallback, posting_line
from wordloom.operators import drop_stop_words, parent_child_list
from wordloom.sources import (
    parse_children,
    parse_entities,
    parse_parents,
    parse_postings,
    split_rejected,
    strict,
    tokens_from_lines,
)


def _lines(df, *fields, sep="\t"):
    return df.select(F.concat_ws(sep, *[F.col(f).cast("string") for f in fields]).alias("value"))


def records_from_lines(spark, sf_dir):
    lines = _lines(documents(spark, sf_dir), "doc_id", "text")
    return drop_stop_words(tokens_from_lines(lines), STOP_WORDS)


def parents_from_tsv(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("none", F.lit(""))
    fields = ["c_custkey", "c_mktsegment", "c_name", "c_nationkey", "none", "none"]
    return strict(parse_parents(_lines(customers, *fields)))


def _child_lines(spark, sf_dir):
    """The label is a balance: four digits look like an age and give way to the name."""
    customers = table(spark, sf_dir, "customer").withColumns(
        {"none": F.lit(""), "label": F.floor("c_acctbal")}
    )
    return _lines(customers, "c_nationkey", *["none"] * 7, "label", "c_name")


def children_from_tsv(spark, sf_dir):
    return strict(parse_children(_child_lines(spark, sf_dir)))


def rejected_lines(spark, sf_dir):
    """Order lines read as parents; the third field is left out for status F."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "tail", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    )
    _, rejected = split_rejected(parse_parents(_lines(orders, "o_orderkey", "o_custkey", "tail")))
    return rejected


def postings_from_text(spark, sf_dir):
    line = posting_line(F.col("word"), F.col("doc_id"), F.col("occurrences"))
    return strict(parse_postings(index(spark, sf_dir).select(line.alias("value"))))


def entities_from_text(spark, sf_dir):
    entities = parent_child_list(document_sources(spark, sf_dir), document_labels(spark, sf_dir))
    columns = ("entity_id", "name", "children")
    lines = entities.select(entity_line(*map(F.col, columns)).alias("value"))
    return strict(parse_entities(lines)).withColumn("children", F.array_join("children", "\t"))


def label_fallback(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    label = label_with_fallback(F.col("p_brand"), F.col("p_type"), None, r"\ABrand#[0-9]\z")
    return parts.select("p_partkey", label.alias("label"))


QUERIES = {
    "records_from_lines": records_from_lines,
    "parents_from_tsv": parents_from_tsv,
    "children_from_tsv": children_from_tsv,
    "rejected_lines": rejected_lines,
    "postings_from_text": postings_from_text,
    "entities_from_text": entities_from_text,
    "label_fallback": label_fallback,
}

ORACLE = {
    "records_from_lines": sql_kept(),
    "parents_from_tsv": "SELECT c_custkey AS entity_id, c_name AS name FROM customer",
    # Fixed value: the pattern of an age, as in the field functions.
    "children_from_tsv": """
        SELECT CAST(c_nationkey AS BIGINT) AS entity_id,
               CASE WHEN regexp_full_match(label, '[0-9]{2}.[0-9]{1}') THEN c_name
                    ELSE label END AS label
        FROM (SELECT *, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS label
              FROM customer)""",
    "rejected_lines": """
        SELECT concat(o_orderkey, chr(9), o_custkey) AS value, 'too few fields' AS problem
        FROM orders WHERE o_orderstatus = 'F'""",
    "postings_from_text": sql_postings(),
    "entities_from_text": """
        SELECT d.doc_id AS entity_id, any_value(source) AS name, CAST(0 AS BIGINT) AS part,
               count(quality) AS n_children,
               coalesce(string_agg(CAST(quality AS VARCHAR), chr(9)), '') AS children
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.doc_id""",
    "label_fallback": """
        SELECT p_partkey,
               CASE WHEN regexp_full_match(p_brand, 'Brand#[0-9]') THEN p_type
                    ELSE p_brand END AS label
        FROM part""",
}
