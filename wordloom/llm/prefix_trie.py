"""The trie of conversations: what each shared beginning holds and would save.

Conversations are rows of turn ids, dealt to ranges of their order and sorted by
numpy within each. Of neighbours only the number of turns that they share from the start is
kept: rows i to j are the members of a node of depth d if all but the first share d turns with
the row before. So every node is a run of rows, and all that is told of it is a sum or a minimum over
the run. Runs that go on in the next range come in pieces, which are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import attached, kept
from wordloom.llm.texts import NULL_ID

HEADS, FIRST = 20, 4  # the first conv_id of HEADS lends up to FIRST - 1 turns to the others
ID_BYTES = 16  # of a turn's id
WIDTH = 8  # turns that a matrix of turn ids holds at once
SHARD_TURNS = 500_000  # turns of a range, about
CHUNK_IDS = 1_024  # conv_ids that go to a digest of several ranges as one row

# Fixed value: the words that a text saves.
WORD = r"[^\x20\x09-\x0D]+"

EMPTY = hashlib.sha256(b"").hexdigest()
SORTED = "shard int, place bigint, is_last boolean, conv bigint, seq binary, words array<int>, lcp int"
NODE = (
    "kind int, depth bigint, origin int, parent_origin int, conv bigint, parent bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string, place bigint"
)
CLOSED, PIECE, ENDS = 0, 1, 2


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv, seq, words): each conversation as turn ids and numbers of words, in its new form.

    ``conv`` is conv_id, or NULL_ID for the rows without one. A turn's id is a
    128-bit digest of role and text, ``seq`` is all ids one after another.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    length = F.octet_length(role).cast("string")
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.md5(F.concat(length, F.lit(":"), role, text).cast("binary")).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    conv = F.coalesce(F.col("conv_id").cast("bigint"), F.lit(NULL_ID))
    own = conversations.select(conv.alias("conv"), turn.alias("turn")).groupBy("conv")
    own = kept(own.agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    plain = lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))
    own = own.select("conv", F.transform("turns", plain).alias("turns"))
    lent = own.where((F.col("conv") % HEADS == 0) & (F.col("conv") != NULL_ID)).select(
        F.col("conv").alias("head"), F.slice("turns", 1, FIRST - 1).alias("lent")
    )
    decimal = F.col("conv").cast("string").cast("binary")
    h = F.when(F.col("conv") == NULL_ID, 0).otherwise(F.crc32(decimal) % FIRST).cast("int")
    own = own.withColumn("h", h).withColumn("head", F.col("conv") - F.col("conv") % HEADS)
    none = F.array().cast("array<struct<id: string, words: int>>")
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    rows = own.join(lent, "head", "left").select(
        "conv",
        F.when(F.col("conv") == NULL_ID, F.col("turns"))
        .otherwise(F.concat(F.slice(F.coalesce("lent", none), F.lit(1), F.col("h")), rest))
        .alias("turns"),
    )
    return rows.select(
        "conv",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("seq"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def lexsorted(
    ids: np.ndarray, start: np.ndarray, length: np.ndarray, last: np.ndarray, width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of rows of ids: sorted by ids, then ``last``; turns shared with the row before.

    Row r has the ids (two numbers each) from ``start[r]``, ``length[r]`` of them. Padded matrices hold
    ``width`` turns at a time, and then only rows that still agree with another.
    """
    n = len(length)
    order, group, lcp = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    active, done = np.arange(n), 0
    while len(active):
        rows = order[active]
        matrix = np.zeros((2 * width, len(rows)), np.uint64)
        for j in range(width):
            has = length[rows] > done + j
            matrix[2 * j : 2 * j + 2, has] = ids[start[rows[has]] + done + j].T
        present = np.minimum(length[rows] - done, width)
        place = np.lexsort((last[rows], present, *matrix[::-1], group[active]))
        rows, matrix = rows[place], matrix[:, place]
        order[active] = rows
        new = np.diff(group[active]) != 0
        changed, shared = new.copy(), np.zeros(len(new), np.int64)
        for j in range(width):
            pair = matrix[2 * j : 2 * j + 2]
            ended = length[rows] <= done + j
            changed |= (pair[:, 1:] != pair[:, :-1]).any(axis=0) | ended[1:] | ended[:-1]
            shared += ~changed
        lcp[active[1:]] += shared  # nothing where a new group starts
        same = shared == width
        group[active] = np.concatenate([[0], np.cumsum(~same)])
        more = np.zeros(len(active), dtype=bool)
        more[1:] |= same
        more[:-1] |= same
        active, done = active[more], done + width
    return order, lcp


def _gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    found = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(found).combine_chunks() if found else None


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range of rows in order, each with the number of turns it shares with the row before."""
    table = _gathered(batches)
    if table is None:
        return
    seq, conv = _column(table, "seq"), table.column("conv").to_numpy()
    at = np.frombuffer(seq.buffers()[1], np.int32)[seq.offset : seq.offset + len(seq) + 1]
    data = seq.buffers()[2]
    ids = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    ids = ids[: len(ids) // ID_BYTES * ID_BYTES].view(">u8").astype(np.uint64).reshape(-1, 2)
    order, lcp = lexsorted(ids, at[:-1] // ID_BYTES, np.diff(at) // ID_BYTES, conv)
    if len(lcp):
        lcp[0] = -1
    shard = TaskContext.get().partitionId()
    n = len(order)
    rows = pa.array(order)
    out = pa.table(
        {
            "shard": pa.array(np.full(n, shard, np.int32)),
            "place": pa.array(np.arange(n)),
            "is_last": pa.array(np.arange(n) == n - 1),
            "conv": pa.array(conv[order]),
            "seq": seq.take(rows),
            "words": _column(table, "words").take(rows),
            "lcp": pa.array(lcp.astype(np.int32)),
        }
    )
    yield from out.to_batches(max_chunksize=10_000)


def _shared_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many turns the first row of a range shares with the last one before it."""
    for batch in batches:
        shared = []
        for before, first in zip(batch.column("before"), batch.column("first")):
            a, b = (np.frombuffer(x.as_py() or b"", np.dtype(f"V{ID_BYTES}")) for x in (before, first))
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            shared.append(int(differ[0]) if len(differ) else n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), pa.array(shared, pa.int32())], names=["shard", "lcp"]
        )


def _seams(rows: DataFrame) -> dict[int, tuple[int, int, list[tuple[int, int]]]]:
    """For each range (shared, shared by the next, origins): how its runs hang on to its neighbours.

    Runs of the first row up to depth ``shared`` began in an earlier range: that
    of depth d in the range o of the first (limit, o) in ``origins`` with d <= limit.
    The driver holds two numbers for each range, and no row.
    """
    spans = rows.groupBy("shard").agg(
        F.min(F.when(F.col("place") > 0, F.col("lcp"))).alias("least"),
        F.min(F.size("words")).alias("length"),
    )
    spans = sorted(map(tuple, spans.collect()))
    shards = [s for s, *_ in spans]
    if not shards:
        return {}
    before = list(zip(shards[1:], shards))
    edges = rows.sparkSession.createDataFrame(before, "shard int, previous int")
    first = rows.where("place = 0").select("shard", F.col("seq").alias("first"))
    last = rows.where("is_last").select(
        F.col("shard").alias("previous"), F.col("seq").alias("before")
    )
    edges = edges.join(first, "shard").join(last, "previous")
    shared = dict(map(tuple, edges.mapInArrow(_shared_turns, "shard int, lcp int").collect()))
    out, tail = {}, []
    for place, (shard, least, length) in enumerate(spans):
        mine = shared.get(shard, -1)
        head = _cut(tail, mine)
        behind = shared.get(shards[place + 1], -1) if place + 1 < len(shards) else -1
        out[shard] = (mine, behind, head)
        through = length if least is None else least  # so many turns all its rows share
        tail = [*_cut(head, min(mine, through)), (1 << 40, shard)]
    return out


def _cut(origins: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    out = []
    for end, origin in origins:
        if out and out[-1][0] >= limit or limit < 0:
            break
        out.append((min(end, limit), origin))
    return out


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(_decimals(ids).encode()).hexdigest()


def _decimals(ids: list[int]) -> str:
    return ",".join("" if i == NULL_ID else str(i) for i in ids)


class Nodes:
    """Columns of nodes, piece by piece."""

    names = [c.split()[0] for c in NODE.split(", ")]

    def __init__(self):
        self.parts: list[pa.RecordBatch] = []

    def add(self, n: int, **columns) -> None:
        arrays = []
        for name, kind in (c.split() for c in NODE.split(", ")):
            value = columns.get(name)
            form = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind]
            if value is None or np.isscalar(value) and not isinstance(value, str):
                arrays.append(pa.nulls(n, form) if value is None else pa.array(np.full(n, value), form))
            elif isinstance(value, str):
                arrays.append(pa.array([value] * n, form))
            else:
                arrays.append(value if isinstance(value, pa.Array) else pa.array(value, form))
        self.parts.append(pa.RecordBatch.from_arrays(arrays, names=self.names))


def _masked(values: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=null)


def trie_nodes(
    conv: np.ndarray,
    length: np.ndarray,
    words: np.ndarray,
    lcp: np.ndarray,
    seam: tuple[int, int, list[tuple[int, int]]],
    shard: int,
) -> list[pa.RecordBatch]:
    """The nodes of a range's rows: whole ones, and pieces of those that reach beyond it."""
    shared, behind, origins = seam
    n = len(conv)
    lcp = lcp.astype(np.int64)
    lcp[0] = shared
    following = np.append(lcp[1:], behind)
    upto = np.concatenate([[0], np.cumsum(words)])
    base = np.concatenate([[0], np.cumsum(length)])[:-1]
    saves = upto[base + np.maximum(lcp, 0)] - upto[base]  # words of the turns shared with the row before
    leaf = following < length
    most = np.maximum(np.maximum(lcp, following), 0)
    parent, parent_origin = np.zeros(n, np.int64), np.full(n, -2, np.int64)  # -2: no parent
    out = Nodes()
    rows = np.arange(n)
    depth = 0
    while len(rows):
        first = lcp[rows] < depth
        head = bool(rows[0] == 0 and lcp[0] >= depth)
        first[0] = True
        at = np.flatnonzero(first)
        size = np.diff(np.append(at, len(rows)))
        opened = np.repeat(True, len(at))  # whose first row is the node's first
        opened[0] = not head
        tail = bool(rows[-1] == n - 1 and behind >= depth)
        ours = np.zeros(len(at), dtype=bool)
        ours[0] |= head
        ours[-1] |= tail
        origin = np.where(ours, shard, -1)
        if head:
            origin[0] = next(o for end, o in origins if depth <= end)
        least = np.minimum.reduceat(conv[rows], at)
        before = upto[base[rows] + max(depth - 1, 0)] - upto[base[rows]]
        saved = saves[rows] - before
        saved[at[opened]] = 0
        starts = (lcp[rows] == depth) & (length[rows] > depth)
        starts[at[opened]] = length[rows[at[opened]]] > depth
        ending = length[rows] == depth
        n_ends = np.add.reduceat(ending.astype(np.int64), at)
        values = {
            "depth": depth,
            "conv": least,
            "n_convs": size,
            "n_children": np.add.reduceat(starts.astype(np.int64), at),
            "n_leaves": np.add.reduceat(leaf[rows].astype(np.int64), at),
            "saved": np.add.reduceat(saved, at),
        }
        above, above_origin = parent[rows[at]], parent_origin[rows[at]]
        closed = np.flatnonzero(~ours)
        if len(closed):
            ends = [EMPTY] * len(closed)
            for k in np.flatnonzero(n_ends[closed]).tolist():
                i = at[closed[k]]
                ends[k] = _digest(conv[rows[i : i + n_ends[closed[k]]]].tolist())
            some = {c: v[closed] if isinstance(v, np.ndarray) else v for c, v in values.items()}
            out.add(
                len(closed),
                kind=CLOSED,
                **some,
                parent=_masked(above[closed], above_origin[closed] != -1),
                parent_origin=pa.array(above_origin[closed], pa.int32(), mask=above_origin[closed] < 0),
                ends=pa.array(ends),
            )
        for k in np.flatnonzero(ours).tolist():
            some = {c: v[k : k + 1] if isinstance(v, np.ndarray) else v for c, v in values.items()}
            key = {"origin": int(origin[k]), "depth": depth}
            up = int(above_origin[k])
            out.add(1, kind=PIECE, **some, origin=key["origin"], parent_origin=None if up < 0 else up)
            ids = conv[rows[at[k] : at[k] + n_ends[k]]].tolist()
            for i in range(0, len(ids), CHUNK_IDS):
                out.add(1, kind=ENDS, **key, ends=_decimals(ids[i : i + CHUNK_IDS]), place=i, n_convs=shard)
        parent[rows], parent_origin[rows] = np.repeat(least, size), np.repeat(origin, size)
        rows = rows[most[rows] > depth]
        depth += 1
    _single(out, conv, length, most, parent, parent_origin)
    return out.parts


def _single(out: Nodes, conv, length, most, parent, parent_origin) -> None:
    """Nodes of one conversation alone, below all that it shares."""
    count = length - most
    rows = np.repeat(np.arange(len(conv)), count)
    if not len(rows):
        return
    depth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) + most[rows] + 1
    top, end = depth == most[rows] + 1, depth == length[rows]
    above = np.where(top, parent[rows], conv[rows])
    origin = np.where(top, parent_origin[rows], -1)
    ends = np.full(len(rows), EMPTY, dtype=object)
    ends[end] = [_digest([c]) for c in conv[rows[end]].tolist()]
    out.add(
        len(rows),
        kind=CLOSED,
        depth=depth,
        conv=conv[rows],
        n_convs=1,
        n_children=(~end).astype(np.int64),
        n_leaves=1,
        saved=0,
        parent=_masked(above, origin >= 0),
        parent_origin=pa.array(origin, pa.int32(), mask=origin < 0),
        ends=pa.array(ends, pa.string()),
    )


def _nodes(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _gathered(batches)
        if table is None:
            return
        words = _column(table, "words")
        shards = table.column("shard").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for at, end in zip(bounds, bounds[1:]):
            mine = words.slice(at, end - at)
            part = table.slice(at, end - at)
            for batch in trie_nodes(
                part.column("conv").to_numpy(),
                mine.value_lengths().to_numpy().astype(np.int64),
                mine.flatten().to_numpy(),
                part.column("lcp").to_numpy(),
                shared.value[int(shards[at])],
                int(shards[at]),
            ):
                for start in range(0, batch.num_rows, 10_000):
                    yield batch.slice(start, 10_000)

    return run


def _whole_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (depth, origin, ends) one digest for each node, read as a stream."""
    key, digest, out = None, None, []
    for batch in batches:
        for depth, origin, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "origin", "ends"))):
            if (depth, origin) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (depth, origin), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if key is not None:
        out.append((*key, digest.hexdigest()))
    columns = list(zip(*out)) or [(), (), ()]
    kinds = (pa.int64(), pa.int32(), pa.string())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["depth", "origin", "ends"]
    )


def _opened(nodes: DataFrame) -> DataFrame:
    """Pieces added up: one row for each node that reaches over several ranges."""
    key = ["depth", "origin"]
    whole = nodes.where(F.col("kind") == PIECE).groupBy(key)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    whole = whole.agg(F.min("conv").alias("conv"), F.max("parent_origin").alias("parent_origin"), *sums)
    chunks = nodes.where(F.col("kind") == ENDS).select(*key, "n_convs", "place", "ends")
    chunks = chunks.repartition(*key).sortWithinPartitions(*key, "n_convs", "place").drop("n_convs", "place")
    ends = chunks.mapInArrow(_whole_digests, "depth bigint, origin int, ends string")
    return whole.join(ends, key, "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY)))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, the empty one included.

    Turns are ordered by ``turn``, null first, ties by the digest of role and
    text; null role or text is empty, repeated rows are turns of their own.
    Conversation c then has the first h turns of conversation c - c % 20, fewer
    if that has fewer, and its own turns behind its first h, with h the CRC-32 of
    the decimal c modulo 4. Rows without conv_id are one conversation, which
    stays as it is, stands before all numbers and has an empty decimal.

    A node has the columns conv_id (its least member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256. An empty table
    has no nodes. Other columns are not read. A conversation is one row, 20 bytes
    a turn and 60 while it is put together, however many turns it has; ranges hold
    about ``shard_turns`` turns.
    """
    spark = conversations.sparkSession
    rows = kept(rebuilt(conversations))
    turns = rows.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    rows = rows.repartitionByRange(ranges, "seq", "conv").mapInArrow(_sorted, SORTED)
    rows = kept(rows)  # a partition is a range, here and below
    shared = spark.sparkContext.broadcast(_seams(rows))
    nodes = kept(rows.mapInArrow(_nodes(shared), NODE))
    opened = kept(_opened(nodes))
    columns = ["depth", "conv", "parent_origin", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    closed = nodes.where(F.col("kind") == CLOSED).select(*columns, "parent")
    both = closed.unionByName(opened.select(*columns, F.lit(None).cast("bigint").alias("parent")))
    above = opened.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("origin").alias("parent_origin"),
        F.col("conv").alias("above"),
    )
    both = attached(both, above, ["depth", "parent_origin"], ["conv"])
    known = lambda c: F.when(c != NULL_ID, c)
    parent: Column = F.coalesce("parent", "above")
    return both.select(
        known(F.col("conv")).alias("conv_id"),
        "depth",
        known(parent).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
