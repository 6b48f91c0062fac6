"""Vectors that nearly point the same way, by cover trees traversed in pairs.

Equal vectors are one class. The upper levels of the tree are fitted on a bounded
draw of classes; every class goes to the nearest of their lowest centres, its
cell. Cells in the order of the tree are packed into shards of bounded size, and a cell beyond
that is dealt over several. Each shard gets the rest of the tree, with halving
radii, as one row. Pairs of shards are the upper part of the dual traversal:
those that covering radii part are dropped, first for groups of shards, then for
shards; the others descend both trees in a task. What radii prove to be linked
as a whole is counted without its pairs, and of links only counts and the roots
they join leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from wordloom.llm.cover_tree import CoverTree, links_between, links_within
from wordloom.llm.near_duplicates import components
from wordloom.llm.tables import attached, kept
from wordloom.llm.texts import NULL_ID

COSINE = 0.95
SAMPLE = 1_024  # classes on which the upper levels are fitted
SHARD = 2_048  # classes below one shard
SHARD_BYTES = 32 * 1024 * 1024  # of their vectors in double precision
GROUP = 256  # shards that are compared as one first
CHUNK = 16  # trees that meet one copy of another

ROW = "dim int, class bigint, n bigint"
NODES = ("first", "last", "down", "fan", "radius")
LINKS = "class bigint, links bigint, root bigint, other bigint"


def _usable(e: Column) -> Column:
    """Vectors of finite components that are not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(e, bad) & F.exists(e, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _drawn(classes: DataFrame, most: int) -> dict[int, np.ndarray]:
    """The lowest centres of the upper levels, by dimension, in the order of the tree.

    At most ``most`` classes, of least hash, are brought to the driver.
    """
    rate = max(1, classes.count() // (4 * most))
    place = F.xxhash64("class")
    some = classes.where(F.pmod(place, F.lit(rate)) == 0).orderBy(place, "class").limit(most)
    found: dict[int, list] = {}
    for row in some.select("dim", "e").collect():
        found.setdefault(row["dim"], []).append(row["e"])
    out = {}
    for dim, vectors in found.items():
        tree = CoverTree(np.array(vectors))
        out[dim] = tree.unit
    return out


def _placed(shared) -> Callable:
    """Each class with the number of its cell; -1 where no centre has its dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.full(len(dims), -1, np.int32)
            for dim in np.unique(dims).tolist():
                if dim not in centres:
                    continue
                rows = np.flatnonzero(dims == dim)
                values = np.asarray(_matrix(batch.column("e").take(pa.array(rows))), np.float64)
                values /= np.abs(values).max(axis=1)[:, None]
                for at in range(0, len(rows), 4096):
                    near = values[at : at + 4096].astype(np.float32) @ centres[dim].T
                    cells[rows[at : at + 4096]] = near.argmax(axis=1)
            names = ["dim", "class", "n", "e"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(cells)], names=[*names, "cell"]
            )

    return run


def _shards(placed: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(dim, cell, start, parts), which shards a cell is dealt to, and how many shards there are.

    There is a row for each cell, so few.
    """
    sizes = placed.groupBy("dim", "cell").count().collect()
    rows, shard, room, before = [], -1, 0, None
    for dim, cell, count in sorted(map(tuple, sizes)):
        limit = max(1, min(most, SHARD_BYTES // (8 * dim)))
        parts = -(-count // limit)
        if parts > 1 or dim != before or count > room:
            shard, room = shard + 1, limit
        rows.append((dim, cell, shard, parts))
        if parts > 1:
            shard, room = shard + parts - 1, 0
        room, before = room - count, dim
    spark = placed.sparkSession
    return spark.createDataFrame(rows, "dim int, cell int, start int, parts int"), shard + 1


def _build(least: float, element: pa.DataType) -> Callable:
    """Each shard's tree as one row, with counts and roots of the links within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [batch for batch in batches if batch.num_rows]
        if not found:
            return
        rows = pa.Table.from_batches(found)
        shards = rows.column("shard").to_numpy()
        for shard in np.unique(shards).tolist():
            yield tree_row(shard, rows.filter(pa.array(shards == shard)).combine_chunks())

    def tree_row(shard: int, table: pa.Table) -> pa.RecordBatch:
        values = _matrix(table.column("e"))
        tree = CoverTree(values)
        weights = table.column("n").to_numpy()[tree.order]
        classes = table.column("class").to_numpy()[tree.order]
        counts, roots = links_within(tree, weights, least)
        centre = tree.values[0] / tree.norm[0]
        lists = [classes, weights, counts, classes[roots]]
        lists += [getattr(tree, name) for name in NODES]
        kinds = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.float64()]
        columns = [
            pa.array([shard], pa.int32()),
            pa.array([values.shape[1]], pa.int32()),
            pa.array([centre], pa.list_(pa.float64())),
            pa.array([tree.radius[0]], pa.float64()),
            *(pa.array([x.astype(k.to_pandas_dtype())], pa.list_(k)) for x, k in zip(lists, kinds)),
            pa.array([values[tree.order].ravel()], pa.list_(element)),
        ]
        names = ["shard", "dim", "centre", "bound", "classes", "weights", "links", "roots"]
        return pa.RecordBatch.from_arrays(columns, names=[*names, *NODES, "vectors"])

    return run


def _tree_schema(element: str) -> str:
    longs = "classes array<bigint>, weights array<bigint>, links array<bigint>, roots array<bigint>"
    nodes = ", ".join(f"{x} array<int>" for x in NODES[:-1]) + ", radius array<double>"
    return (
        f"shard int, dim int, centre array<double>, bound double, {longs}, {nodes},"
        f" vectors array<{element}>"
    )


def _balls(table: pa.Table) -> pa.Table:
    """One ball around those of a group of shards."""
    centres = _matrix(table.column("centre"))
    away = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres[0])) + 1e-6
    return pa.table(
        {
            "dim": table.column("dim").slice(0, 1),
            "group": table.column("group").slice(0, 1),
            "centre": table.column("centre").slice(0, 1),
            "bound": pa.array([float((away + table.column("bound").to_numpy()).max())]),
        }
    )


def _pairs(trees: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of shards, a before b, that covering radii do not part.

    Descends from groups of shards, of which the driver holds a ball each (one for GROUP *
    SHARD classes), to the shards themselves.
    """
    reach = math.sqrt(2 - 2 * least) + 1e-6
    group = F.floor(F.col("shard") / GROUP).cast("int")
    balls = trees.select("shard", "dim", "centre", "bound", group.alias("group"))
    tops = balls.groupBy("dim", "group").applyInArrow(
        _balls, "dim int, group int, centre array<double>, bound double"
    )
    tops = sorted(tops.collect(), key=lambda r: (r["dim"], r["group"]))
    near = []
    for dim in sorted({r["dim"] for r in tops}):
        mine = [r for r in tops if r["dim"] == dim]
        centres = np.array([r["centre"] for r in mine])
        bounds = np.array([r["bound"] for r in mine])
        for i, row in enumerate(mine):
            away = np.sqrt(np.maximum(0, 2 - 2 * centres[i:] @ centres[i]))
            for j in np.flatnonzero(away <= bounds[i] + bounds[i:] + reach):
                near.append((dim, row["group"], mine[i + j]["group"]))
    names = {"shard": "{0}", "group": "group_{0}", "centre": "centre_{0}", "bound": "bound_{0}"}
    side = lambda x: balls.select("dim", *(F.col(c).alias(n.format(x)) for c, n in names.items()))
    pairs = trees.sparkSession.createDataFrame(near, "dim int, group_a int, group_b int")
    pairs = pairs.join(side("a"), ["dim", "group_a"]).join(side("b"), ["dim", "group_b"])
    product = F.aggregate(
        F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )
    away = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * product))
    return pairs.where("a < b").where(away <= F.col("bound_a") + F.col("bound_b") + reach).select("a", "b")


def _meet(least: float) -> Callable:
    """Of sorted rows (a, chunk, role, tree): the first tree of a chunk against those behind it."""

    def tree_of(batch: pa.RecordBatch, row: int) -> tuple:
        dim = batch.column("dim")[row].as_py()
        get = lambda name: batch.column(name)[row].values.to_numpy()
        tree = CoverTree.stored(get("vectors").reshape(-1, dim), *map(get, NODES))
        return tree, get("classes"), get("weights"), get("roots")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        front = None
        for batch in batches:
            for row in range(batch.num_rows):
                tree, classes, weights, roots = tree_of(batch, row)
                if not batch.column("role")[row].as_py():
                    front = tree, classes, weights, roots
                    continue
                own = front[0]
                counts, joined = links_between(own, tree, front[2], weights, least)
                classes = np.concatenate([front[1], classes])
                roots = np.concatenate([front[3], roots])
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(x[some], pa.int64()) for x in (classes, counts)),
                        *(pa.nulls(len(some), pa.int64()) for _ in range(2)),
                    ],
                    names=["class", "links", "root", "other"],
                )
                edges = np.unique(np.stack([roots, roots[joined]], axis=1), axis=0)
                edges = edges[edges[:, 0] != edges[:, 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.nulls(len(edges), pa.int64()) for _ in range(2)),
                        *(pa.array(np.ascontiguousarray(x), pa.int64()) for x in edges.T),
                    ],
                    names=["class", "links", "root", "other"],
                )

    return run


def _met(trees: DataFrame, least: float) -> DataFrame:
    """Links between shards: (class, links) counts, and (root, other) that they join."""
    chunk = F.floor(F.col("b") / CHUNK).cast("int").alias("chunk")
    pairs = kept(_pairs(trees, least).select("a", "b", chunk))
    trees = trees.drop("centre", "bound", "links")
    behind = pairs.join(trees.withColumnRenamed("shard", "b"), "b").withColumn("role", F.lit(1))
    front = pairs.select("a", "chunk").distinct().withColumn("b", F.lit(-1))
    front = front.join(trees.withColumnRenamed("shard", "a"), "a").withColumn("role", F.lit(0))
    rows = front.unionByName(behind).repartition("a", "chunk")
    return rows.sortWithinPartitions("a", "chunk", "role", "b").mapInArrow(_meet(least), LINKS)


def embedding_links(
    vectors: DataFrame, least: float = COSINE, shard: int = SHARD, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Two rows are linked if the cosine of ``embedding``, in double precision, is at
    least ``least`` (above 0). ``n_links`` counts the other rows linked with a row,
    ``component_id`` is the least vec_id that links reach, null standing before
    all numbers, and ``kept`` tells whether it is the row's own. A vector that is
    null, empty, all zeros, or holds a null or a component that is not finite is
    linked with nothing, nor are vectors of different lengths. Rows that repeat a
    vec_id are rows of their own. Other columns are not read. ``sample`` classes
    are drawn for the upper levels, which only decide what is compared together:
    all pairs are either compared or parted by covering radii, so links are exact.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, ArrayType):
        raise TypeError("embedding must be a list of numbers")
    element = "float" if isinstance(kind.elementType, FloatType) else "double"
    arrow = pa.float32() if element == "float" else pa.float64()
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast(f"array<{element}>").alias("e"),
    ).withColumn("_id", F.coalesce("vec_id", F.lit(NULL_ID)))
    usable = rows.where(_usable(F.col("e")))
    keys = (F.xxhash64("e"), F.xxhash64(F.lit(1), "e"))  # of a class, 128 bits
    found = usable.groupBy("e").agg(F.min("_id").alias("least"), F.count("*").alias("n"))
    found = found.withColumns({"h1": keys[0], "h2": keys[1], "dim": F.size("e")})
    found = kept(found.withColumn("class", F.monotonically_increasing_id()))

    shared = spark.sparkContext.broadcast(_drawn(found, sample))
    placed = found.select("dim", "class", "n", "e")
    placed = kept(placed.mapInArrow(_placed(shared), f"{ROW}, e array<{element}>, cell int"))
    cells, shards = _shards(placed, shard)
    number = F.col("start") + F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    dealt = placed.join(F.broadcast(cells), ["dim", "cell"])
    dealt = dealt.select("class", "n", "e", number.alias("shard"))
    dealt = dealt.repartitionById(max(1, shards), "shard")  # a shard is a task
    trees = kept(dealt.mapInArrow(_build(least, arrow), _tree_schema(element)))
    met = kept(_met(trees, least))

    own = trees.select(F.explode(F.arrays_zip("classes", "links", "roots")).alias("c"))
    own = own.select(
        F.col("c.classes").alias("class"), F.col("c.links").alias("links"), F.col("c.roots").alias("root")
    )
    counts = own.unionByName(met.where("class IS NOT NULL").select("class", "links", "root"))
    counts = counts.groupBy("class").agg(F.sum("links").alias("links"), F.max("root").alias("root"))
    linked = counts.where("links > 0")
    joined = components(
        met.where("root IS NOT NULL").select(F.col("root").alias("a"), F.col("other").alias("b"))
    )
    joined = joined.select(F.col("node").alias("root"), F.col("label"))
    linked = attached(linked, joined, ["root"], ["class"])
    linked = linked.select("class", "links", F.coalesce("label", "root").alias("label"))
    linked = kept(
        found.select("class", "least", "n", "h1", "h2")
        .join(linked, "class", "left")
        .where("links IS NOT NULL OR n > 1")
        .withColumn("label", F.coalesce("label", "class"))
    )
    reached = linked.groupBy("label").agg(F.min("least").alias("reached"))
    linked = attached(linked, reached, ["label"], ["class"])
    told = linked.select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "reached"
    )
    keyed = rows.select(
        "vec_id", "_id", *(F.when(_usable(F.col("e")), k).alias(c) for k, c in zip(keys, ("h1", "h2")))
    )
    reached = F.coalesce("reached", "_id")
    return attached(keyed, kept(told), ["h1", "h2"], ["vec_id"]).select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(reached != NULL_ID, reached).alias("component_id"),
        (reached == F.col("_id")).alias("kept"),
    )
