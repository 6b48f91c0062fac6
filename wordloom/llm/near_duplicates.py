"""Near-duplicate documents by circulant MinHash, with exact confirmation.

A document is the set of its word shingles. Two permutations give all
coordinates of its signature: the first scatters the shingles, the second,
shifted circularly by k, orders them for coordinate k. Coordinates form bands;
documents that share a band are candidates.

Documents with equal sets are one class. Candidates are not paired with each
other: in each bucket of a band every class is set against the least one, its pivot, on
the full sets. What differs from the pivot is small for near copies, and tells
how far two members of a pivot are from each other; members that the pivot leaves
in different components are compared by that, in blocks. Components of the
confirmed links come from label propagation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import attached, kept
from wordloom.llm.texts import (
    LOWER,
    NULL_ID,
    SMALL_BLOCK,
    blocks,
    give_back,
    identified,
    mixed,
    word_hashes,
    words_of,
)
from wordloom.operators.joins import fits_broadcast

SHINGLE = 3
PERCENT = 85
# A pair at 0.85 shares none of 20 bands of 4 with probability 4e-7.
BANDS, ROWS = 20, 4
GROUP = 256  # sets confirmed against one copy of a pivot's set

# Members of a pivot that meet in one task, on either side.
BLOCK = 4_096

NODE = "struct<_id: bigint, _h: bigint>"
COMPARED = f"node {NODE}, pivot {NODE}, n bigint, linked boolean, diff binary"
FEATURES = (
    "doc_id bigint, _id bigint, _h bigint, n_shingles bigint, set1 bigint, set2 bigint,"
    " bands array<bigint>"
)


def _bijection(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each text of a block the sorted distinct hashes of its shingles."""
    data = LOWER[data]
    starts, ends, first = words_of(data, offsets)
    words = word_hashes(data, starts, ends)
    long = np.zeros(len(words), dtype=np.uint64)
    m = max(0, len(words) - size + 1)
    for i in range(size):
        long[:m] = mixed(long[:m] * np.uint64(0x9E3779B97F4A7C15) + words[i : i + m])
    sets = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            sets.append(np.unique(long[a : b - size + 1]))
        elif b > a:
            value = np.array([b - a], dtype=np.uint64)  # the whole sequence, told apart by its length
            for word in words[a:b]:
                value = mixed(value * np.uint64(3) + word)
            sets.append(value)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def band_keys(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """A key for each band of each set; sets must not be empty."""
    if not sets:
        return np.zeros((0, bands), np.int64)
    members = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    scattered = _bijection((members >> np.uint64(32)).astype(np.uint32) ^ members.astype(np.uint32))
    keys = np.zeros((len(sets), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, dtype=np.uint64)
        for k in range(band * rows, band * rows + rows):
            shifted = scattered - np.uint32(k)  # circular, modulo 2**32
            least = np.minimum.reduceat(_bijection(shifted ^ np.uint32(0x5BD1E995)), first)
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + least.astype(np.uint64))
        keys[:, band] = key
    return keys.view(np.int64)


def _features(shingle: int, bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, limit=SMALL_BLOCK):
            sets = shingle_sets(data, offsets, shingle)
            filled = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys([sets[i] for i in filled], bands, rows)
            lists: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sets)
            for i, row in zip(filled, keys):
                lists[i] = row
            whole = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(whole), np.int64).reshape(-1, 2)
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("_id"),
                    part.column("_h"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0], pa.int64()),
                    pa.array(halves[:, 1], pa.int64()),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=[f.split()[0] for f in FEATURES.split(", ")],
            )
        give_back()

    return run


def _confirm(shingle: int, percent: int) -> Callable:
    """Of sorted rows (pivot, part, member, node, text), each member set against its pivot.

    The pivot's own row stands in front of its members. ``diff`` holds the
    shingles that only one of both has, sorted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, np.uint64)
        for part, data, offsets in blocks(batches, limit=SMALL_BLOCK):
            rows, sizes, linked, diffs = [], [], [], []
            sets = shingle_sets(data, offsets, shingle)
            for row, (is_member, members) in enumerate(zip(part.column("member").to_pylist(), sets)):
                if not is_member:
                    own = members
                    continue
                diff = np.setxor1d(own, members, assume_unique=True)
                both = (len(own) + len(members) - len(diff)) // 2
                rows.append(row)
                sizes.append(len(members))
                linked.append(100 * both >= percent * (both + len(diff)))
                diffs.append(diff.tobytes())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(at) for c in ("node", "pivot")),
                    pa.array(sizes, pa.int64()),
                    pa.array(linked, pa.bool_()),
                    pa.array(diffs, pa.binary()),
                ],
                names=["node", "pivot", "n", "linked", "diff"],
            )

    return run


def _compare(percent: int) -> Callable:
    """Links between the rows of a block in front and those behind, all around one pivot.

    Two sets differ where their differences from the pivot differ. So sizes and
    the number of shingles that both differences hold give the similarity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, front = None, []
        index: tuple | None = None
        columns = ("pivot", "u", "v", "behind", "node", "label", "n", "diff")
        for batch in batches:
            found = []
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                *own, behind, node, label, n, diff = row
                diff = np.frombuffer(diff, np.uint64)
                if own != block:
                    block, front, index = own, [], None
                if not behind:
                    front.append((node, label, n, diff))
                    continue
                if not front:
                    continue
                if index is None:
                    members = np.concatenate([f[3] for f in front])
                    owner = np.repeat(np.arange(len(front)), [len(f[3]) for f in front])
                    order = np.argsort(members, kind="stable")
                    sizes = np.array([f[2] for f in front])
                    lengths = np.array([len(f[3]) for f in front])
                    index = members[order], owner[order], sizes, lengths
                members, owner, sizes, lengths = index
                low = np.searchsorted(members, diff)
                count = np.searchsorted(members, diff, side="right") - low
                at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                common = np.bincount(owner[at], minlength=len(front))
                apart = lengths + len(diff) - 2 * common
                both = (sizes + n - apart) // 2
                for i in np.flatnonzero(100 * both >= percent * (both + apart)):
                    if front[i][1] != label:
                        found.append((front[i][0], node))
            kind = batch.schema.field("node").type
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], kind) for i in (0, 1)], names=["a", "b"]
            )

    return run


def _compared(texts: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, pivot, n, linked, diff) of the pairs (node, pivot).

    A pivot with many members is copied once for every GROUP of them.
    """
    sizes = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    sizes = kept(sizes)
    # Only pivots with several parts are looked up: at most one for every GROUP pairs.
    members = attached(pairs, sizes.where("parts > 1"), ["pivot"], ["node"]).select(
        "pivot",
        F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
        F.lit(True).alias("member"),
        "node",
    )
    copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pivots = sizes.select(
        "pivot", copies.alias("part"), F.lit(False).alias("member"), F.col("pivot").alias("node")
    )
    rows = members.unionByName(pivots).join(texts, "node")
    rows = rows.select("pivot", "part", "member", "node", "text")
    rows = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", "member")
    return rows.mapInArrow(_confirm(shingle, percent), COMPARED)


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each component of the links (a, b).

    Each round takes the least label among neighbours, then the label's own
    label, until nothing changes.
    """
    other_way = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = kept(links.unionByName(other_way).distinct())
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = kept(labels.select("node", F.least("node", "label").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        least = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
        )
        above = least.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = kept(
            least.join(above, "label", "left").select(
                "node", F.least("label", "above").alias("label"), "old"
            )
        )
        if labels.where(F.col("label") != F.col("old")).isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _left_apart(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between members of a pivot that have different labels.

    Members under the most common label of their pivot need not meet each other.
    All others meet all members, block by block; no pair leaves a task but links.
    """
    rows = compared.select("node", "pivot", "n", "diff").join(labels, "node", "left")
    rows = rows.withColumn("label", F.coalesce("label", "node"))
    by_label = rows.groupBy("pivot", "label").agg(F.count("*").alias("m"))
    several = by_label.groupBy("pivot").agg(
        F.count("*").alias("labels"),
        F.max(F.struct("m", "label")).alias("most"),
        F.sum("m").alias("members"),
    )
    several = several.where("labels > 1").select(
        "pivot",
        F.col("most.label").alias("most"),
        F.ceil((F.col("members") - F.col("most.m")) / BLOCK).cast("int").alias("us"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("vs"),
    )
    rows = attached(rows, kept(several), ["pivot"], ["node"]).where("most IS NOT NULL")
    place = lambda parts: F.pmod(F.xxhash64("node"), parts).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    what = ["node", "label", "n", "diff"]
    front = rows.where("label <> most").select(
        "pivot", place("us").alias("u"), every("vs").alias("v"), F.lit(False).alias("behind"), *what
    )
    behind = rows.select(
        "pivot", every("us").alias("u"), place("vs").alias("v"), F.lit(True).alias("behind"), *what
    )
    blocks_ = front.unionByName(behind).repartition("pivot", "u", "v")
    blocks_ = blocks_.sortWithinPartitions("pivot", "u", "v", "behind")
    return blocks_.mapInArrow(_compare(percent), f"a {NODE}, b {NODE}")


def similar_classes(
    texts: DataFrame, classes: DataFrame, shingle: int, percent: int
) -> DataFrame | None:
    """(node, label) for the classes that have links, None if no two share a band.

    ``classes`` is (node, bands), ``texts`` (node, text) for at least those nodes.
    """
    exploded = classes.select("node", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("m"))
    pairs = exploded.join(shared.where("m > 1").drop("m"), "band").where("node <> pivot")
    pairs = kept(pairs.select("node", "pivot").distinct())
    if pairs.isEmpty():
        return None
    nodes = pairs.select("node").union(pairs.select("pivot")).distinct()
    if fits_broadcast(nodes):
        nodes = F.broadcast(nodes)
    texts = texts.join(nodes, "node", "left_semi")
    compared = kept(_compared(texts, pairs, shingle, percent))
    links = compared.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    labels = components(links)
    more = kept(_left_apart(compared, labels, percent))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    return labels


def _with_least(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, _id, _h, n_shingles, least, ...): each row with the least node of its component."""
    keyed = identified(docs)
    features = kept(keyed.mapInArrow(_features(shingle, BANDS, ROWS), FEATURES))
    classes = features.where("n_shingles > 0").groupBy("set1", "set2")
    classes = kept(
        classes.agg(F.min(F.struct("_id", "_h")).alias("node"), F.first("bands").alias("bands"))
    )
    labels = similar_classes(
        keyed.select(F.struct("_id", "_h").alias("node"), "text"),
        classes.select("node", "bands"),
        shingle,
        percent,
    )
    least = classes.select("set1", "set2", "node")
    if labels is not None:
        least = least.join(labels, "node", "left").select(
            "set1", "set2", F.coalesce("label", "node").alias("node")
        )
    least = least.withColumnRenamed("node", "least")
    rows = features.drop("bands").join(least, ["set1", "set2"], "left")
    own = F.struct("_id", "_h")
    return rows.withColumn("least", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(own))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, _id, _h, n_shingles, component_id, kept), one row per row of ``docs``.

    A set of ``shingle``-word shingles, lower case A-Z, links with those of which
    the intersection is at least ``percent`` hundredths of the union. A text with
    fewer words is one shingle as a whole; one without words, null included, is
    linked with nothing. ``component_id`` is the least doc_id of the component,
    null standing before all numbers; ``kept`` tells whether it is the row's own.
    Of rows that repeat a doc_id with another text, each is a document. Other
    columns are not read. (``_id``, ``_h``) names the row in ``identified(docs)``.
    Shingles are told apart by 64-bit hashes.
    """
    least_id = F.col("least._id")
    return _with_least(docs, shingle, percent).select(
        "doc_id",
        "_id",
        "_h",
        "n_shingles",
        F.when(least_id != NULL_ID, least_id).alias("component_id"),
        (least_id == F.col("_id")).alias("kept"),
    )


def without_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row of each component of ``docs``, with all columns: that of the least id.

    Of rows of a component that share the least id, the one with the least hash of
    the text. Of rows without words, those with the same doc_id and text are one.
    """
    kept = _with_least(docs, shingle, percent).where(F.col("least") == F.struct("_id", "_h"))
    kept = kept.select("_id", "_h").distinct()
    names = {"_id": "_id", "_h": "_h"}
    for name in names:
        while names[name] in docs.columns:
            names[name] += "_"
    keyed = docs.withColumns(
        {
            names["_id"]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)),
            names["_h"]: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        }
    )
    kept = kept.withColumnsRenamed(names)
    on = [names["_id"], names["_h"]]
    return keyed.join(kept, on, "left_semi").dropDuplicates(on).select(docs.columns)
