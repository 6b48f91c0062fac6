"""Parents with the ordered list of their children.

The form that does not depend on sizes is rows, ``child_rows``: one per child,
with its ``rank`` among the children of its parent. ``parent_child_list`` makes
one row per parent with the whole list, whatever its length. Where lists may be
too long for one value, the caller states a part length, and every list is cut
by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.operators.joins import salted_join
from wordloom.scratch import kept


def last_per_key(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The last whole row of each key; null comes first in the order. Aggregates
    before the shuffle."""
    others = [c for c in rows.columns if c not in keys]
    # A struct is never null, so rows whose order is null take part.
    order = F.struct(*order_by)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_last"))
    return last.select(*[c if c in keys else F.col("_last")[c].alias(c) for c in rows.columns])


def parents_only(parents: DataFrame) -> DataFrame:
    """(entity_id, name) of every record, without a join."""
    return parents.select("entity_id", "name")


def restrict_to(
    rows: DataFrame, ids: DataFrame, few: bool, salt_by: Sequence[str] = ("pos",)
) -> DataFrame:
    """The rows with one of the distinct ids, which are broadcast if they are few."""
    if few:
        return rows.join(F.broadcast(ids), "entity_id", "left_semi")
    return salted_join(rows, ids, ["entity_id"], "left_semi", salt_by)


def child_rows(children: DataFrame, order_by: Sequence[str] = ("pos",)) -> DataFrame:
    """(entity_id, rank, label): every child with its place among its parent's children.

    Children are dealt to ranges of (entity_id, order, label), so a parent with very
    many of them spreads over several ranges, those in equal places, too. The rank is the place within the
    range plus the children in earlier ranges: a running sum over as many rows
    as the parent has ranges, however its positions lie.
    """
    keys = ["entity_id", *order_by]
    ranged = children.select(*keys, "label").repartitionByRange(*keys, "label")
    # Read twice below; ranges drawn anew might differ.
    ranged = kept(ranged.withColumn("_range", F.spark_partition_id()))
    earlier = (
        Window.partitionBy("entity_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        ranged.groupBy("entity_id", "_range")
        .agg(F.count("*").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    within = Window.partitionBy("entity_id", "_range").orderBy(*order_by, "label")
    placed = ranged.withColumn("_place", F.row_number().over(within)).alias("l")
    same = F.col("l.entity_id").eqNullSafe(F.col("r.entity_id")) & (
        F.col("l._range") == F.col("r._range")
    )
    return placed.join(before.alias("r"), same).select(
        F.col("l.entity_id").alias("entity_id"),
        (F.col("_before") + F.col("_place") - 1).alias("rank"),
        "label",
    )


def parent_child_list(
    parents: DataFrame,
    children: DataFrame,
    order_by: Sequence[str] = ("pos",),
    part_length: int | None = None,
    part_bytes: int | None = None,
) -> DataFrame:
    """(entity_id, name, part, n_children, children), every parent kept, the last
    name of an id that comes twice.

    Without ``part_length`` each parent has one row, with its whole list. With
    it, lists are cut after every ``part_length`` children, and ``part`` numbers
    the pieces; ``part_bytes`` ends a piece sooner, once it holds so many bytes. A list without children has the one part 0.
    """
    parents = last_per_key(
        parents.select("entity_id", "name", *order_by), ["entity_id"], order_by
    ).select("entity_id", "name")
    if part_length is None:
        if part_bytes is not None:
            raise ValueError("part_bytes goes with part_length")
        lists = children.groupBy("entity_id").agg(
            F.count("*").alias("n_children"), _in_order(order_by).alias("children")
        )
        lists = lists.withColumn("part", F.lit(0).cast("bigint"))
    else:
        lists = _in_parts(children, order_by, part_length, part_bytes)
    return parents.join(lists, "entity_id", "left").select(
        "entity_id",
        "name",
        F.coalesce("part", F.lit(0).cast("bigint")).alias("part"),
        F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        F.coalesce("children", F.array().cast("array<string>")).alias("children"),
    )


def _in_parts(
    children: DataFrame, order_by: Sequence[str], part_length: int, part_bytes: int | None
) -> DataFrame:
    """(entity_id, part, n_children, children) without bringing a parent's rows together."""
    rows = child_rows(children.where(F.col("entity_id").isNotNull()), order_by)
    rows = rows.withColumn("_block", F.floor(F.col("rank") / part_length))
    if part_bytes is not None:
        # Within a block, running bytes divided by the bound number the pieces.
        running = Window.partitionBy("entity_id", "_block").orderBy("rank")
        size = F.coalesce(F.octet_length("label"), F.lit(0)).cast("bigint")
        piece = F.floor((F.sum(size).over(running) - size) / part_bytes)
    else:
        piece = F.lit(0).cast("bigint")
    pieces = rows.withColumn("_piece", piece).groupBy("entity_id", "_block", "_piece")
    pieces = kept(pieces.agg(F.count("*").alias("_n"), _in_order(["rank"]).alias("children")))
    totals = pieces.groupBy("entity_id").agg(F.sum("_n").alias("n_children"))
    numbered = pieces.join(totals, "entity_id")
    if part_bytes is None:
        part = F.col("_block")
    else:
        part = F.row_number().over(Window.partitionBy("entity_id").orderBy("_block", "_piece")) - 1
        keys = pieces.select("entity_id", "_block", "_piece").withColumn("part", part)
        numbered = numbered.join(keys, ["entity_id", "_block", "_piece"])
        part = F.col("part")
    return numbered.select("entity_id", part.cast("bigint").alias("part"), "n_children", "children")


def _in_order(order_by: Sequence[str]) -> Column:
    rows = F.sort_array(F.collect_list(F.struct(*order_by, "label")))
    return F.transform(rows, lambda row: row["label"])
