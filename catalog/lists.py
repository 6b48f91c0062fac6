"""Parents with their ordered lists of children."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import (
    as_children,
    as_parents,
    customers,
    document_labels,
    document_sources,
    orders,
    table,
)
from wordloom.functions import children_text, children_text_compat
from wordloom.operators import child_rows, last_per_key, parent_child_list, parents_only
from wordloom.plans import build_entities

PART_SIZE = 5


def shown(entities, sep=", "):
    return entities.withColumn("children", F.array_join("children", sep))


def conversation_roles(spark, sf_dir):
    """A conversation is named by its last role, the earlier ones are repeats."""
    turns = table(spark, sf_dir, "conversations")
    return parent_child_list(
        as_parents(turns, "conv_id", "role", "turn"), as_children(turns, "conv_id", "role", "turn")
    )


def entities_plain_quotes(spark, sf_dir):
    """Whole texts as names, because they hold double quotes."""
    texts = as_parents(table(spark, sf_dir, "documents"), "doc_id", "text", "doc_id")
    return build_entities(texts, document_labels(spark, sf_dir))


def parts_text_compat(spark, sf_dir):
    """The compat text of a list in parts is that of the whole list, cut."""
    entities = parent_child_list(
        customers(spark, sf_dir), orders(spark, sf_dir), part_length=PART_SIZE
    )
    text = children_text_compat(
        F.col("children"), F.col("n_children"), F.col("part") * PART_SIZE
    )
    return entities.select("entity_id", "part", text.alias("children"))


def sparse_positions(spark, sf_dir):
    """Positions a million apart, once as whole lists and once put together from pieces."""
    children = orders(spark, sf_dir).withColumn("pos", F.col("pos") * 1_000_000)
    parents = customers(spark, sf_dir)
    whole = shown(parent_child_list(parents, children))
    cut = shown(parent_child_list(parents, children, part_length=3))
    joined = cut.groupBy("entity_id", "name", "n_children").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("part", "children"))), lambda p: p["children"]
            ),
            ", ",
        ).alias("joined")
    )
    return whole.join(joined, ["entity_id", "name", "n_children"]).drop("part")


def last_row_null_order(spark, sf_dir):
    """Every third turn has no number; such rows are last only among themselves."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "role", "turn", "text")
    key = F.when(F.col("turn") % 3 != 0, F.col("turn"))
    rows = turns.select(F.concat("conv_id", F.lit("-"), F.col("turn") % 2).alias("k"), "role",
                        "text", key.alias("pos"), "turn")
    last = last_per_key(rows, ["k"], ["pos", "turn"])
    return last.select("k", F.coalesce("pos", F.lit(-1)).alias("pos"), "role", "text")


QUERIES = {
    "child_rows": lambda s, d: child_rows(orders(s, d)),
    "parent_child_list_sparse_positions": sparse_positions,
    "last_row_null_order": last_row_null_order,
    "parent_child_list": lambda s, d: shown(parent_child_list(customers(s, d), orders(s, d))),
    "parent_child_list_parts": lambda s, d: shown(
        parent_child_list(customers(s, d), orders(s, d), part_length=PART_SIZE)
    ),
    "parent_child_list_sparse": lambda s, d: shown(
        parent_child_list(document_sources(s, d), document_labels(s, d))
    ),
    "parent_child_list_repeated": lambda s, d: shown(conversation_roles(s, d)),
    "parents_only": lambda s, d: parents_only(customers(s, d)),
    "children_text": lambda s, d: parent_child_list(customers(s, d), orders(s, d)).select(
        "entity_id", children_text(F.col("children")).alias("children")
    ),
    "children_text_compat": lambda s, d: parent_child_list(customers(s, d), orders(s, d)).select(
        "entity_id", children_text_compat(F.col("children")).alias("children")
    ),
    "children_text_compat_parts": parts_text_compat,
    "entities_plain_quotes": lambda s, d: shown(entities_plain_quotes(s, d)),
}


def sql_lists(parents: str, children: str, sep: str = ", ") -> str:
    """``parents`` gives (entity_id, name, pos), ``children`` (entity_id, label, pos)."""
    return f"""
        SELECT p.entity_id, p.name, CAST(0 AS BIGINT) AS part,
               coalesce(n, 0) AS n_children, coalesce(labels, '') AS children
        FROM (SELECT entity_id, arg_max(name, pos) AS name FROM ({parents}) GROUP BY entity_id) p
        LEFT JOIN (
            SELECT entity_id, count(*) AS n,
                   string_agg(CAST(label AS VARCHAR), '{sep}' ORDER BY pos) AS labels
            FROM ({children}) GROUP BY entity_id) c
        ON c.entity_id = p.entity_id"""


CUSTOMERS = "SELECT c_custkey AS entity_id, c_name AS name, c_custkey AS pos FROM customer"
ORDERS = "SELECT o_custkey AS entity_id, o_orderpriority AS label, o_orderkey AS pos FROM orders"
SOURCES = "SELECT doc_id AS entity_id, source AS name, doc_id AS pos FROM documents"
LABELS = "SELECT doc_id AS entity_id, quality AS label, doc_id AS pos FROM labels"
TURNS = "SELECT conv_id AS entity_id, role AS name, role AS label, turn AS pos FROM conversations"

SQL_PARTS = f"""
    SELECT entity_id, label, pos, count(*) OVER (PARTITION BY entity_id) AS n_children,
           row_number() OVER (PARTITION BY entity_id ORDER BY pos) - 1 AS rank
    FROM ({ORDERS})"""

SQL_COMPAT = f"""
    SELECT c_custkey AS entity_id,
           CASE WHEN k IS NULL THEN '' WHEN k = 1 THEN l[1] || ' '
                ELSE array_to_string(l[1:k - 1], ' ') || l[k] || ' ' END AS children
    FROM customer LEFT JOIN (
        SELECT o_custkey, array_agg(o_orderpriority ORDER BY o_orderkey) AS l, count(*) AS k
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey"""

ORACLE = {
    "child_rows": f"SELECT entity_id, rank, label FROM ({SQL_PARTS})",
    "parent_child_list_sparse_positions": f"""
        SELECT entity_id, name, n_children, children, children AS joined
        FROM ({sql_lists(CUSTOMERS, ORDERS)})""",
    "last_row_null_order": """
        SELECT k, coalesce(pos, -1) AS pos, role, text FROM (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos DESC NULLS LAST, turn DESC) AS n
            FROM (SELECT *, concat(conv_id, '-', turn % 2) AS k,
                         CASE WHEN turn % 3 <> 0 THEN turn END AS pos FROM conversations))
        WHERE n = 1""",
    "parent_child_list": sql_lists(CUSTOMERS, ORDERS),
    "parent_child_list_parts": f"""
        SELECT c_custkey AS entity_id, c_name AS name, coalesce(part, 0) AS part,
               coalesce(n_children, 0) AS n_children, coalesce(children, '') AS children
        FROM customer LEFT JOIN (
            SELECT entity_id, rank // {PART_SIZE} AS part, n_children,
                   string_agg(label, ', ' ORDER BY pos) AS children
            FROM ({SQL_PARTS}) GROUP BY ALL) ON entity_id = c_custkey""",
    "parent_child_list_sparse": sql_lists(SOURCES, LABELS),
    "parent_child_list_repeated": sql_lists(TURNS, TURNS),
    "parents_only": "SELECT c_custkey AS entity_id, c_name AS name FROM customer",
    "children_text": f"SELECT entity_id, children FROM ({sql_lists(CUSTOMERS, ORDERS, ' ')})",
    "children_text_compat": SQL_COMPAT,
    "children_text_compat_parts": f"""
        SELECT c_custkey AS entity_id, coalesce(part, 0) AS part,
               coalesce(children, '') AS children
        FROM customer LEFT JOIN (
            SELECT entity_id, rank // {PART_SIZE} AS part,
                   string_agg(label || CASE WHEN rank = n_children - 2 THEN '' ELSE ' ' END, ''
                              ORDER BY pos) AS children
            FROM ({SQL_PARTS}) GROUP BY ALL) ON entity_id = c_custkey""",
    "entities_plain_quotes": sql_lists(
        "SELECT doc_id AS entity_id, replace(text, '\"', '''') AS name, doc_id AS pos "
        "FROM documents",
        LABELS,
    ),
}
