"""Byte-level BPE: encoding by ranks, and decoding.

The split pattern cuts a text into pre-tokens. Those a task has not met are
sorted into matrices of similar length, one row each, padded. In every round
each row merges its leftmost pair of least rank, found by a hashed lookup of
pairs; the row closes up, and finished rows leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.texts import gives_back, opened, shipped

NONE = np.int32(2**31 - 1)
CELLS = 1 << 20  # of one matrix
CACHE_TOKENS = 300_000  # of a task; a full cache starts anew
LONGEST_ROW = 256  # bytes; a longer pre-token is merged by itself with a heap
LONGEST_KEY = 64

SCHEMA = "doc_id bigint, n_tokens bigint, ids binary"
ADDED = ("n_tokens", "ids", "decoded_sha256")


class Ranks:
    """The vocabulary as arrays: pairs in an open-addressing table, token bytes end to end."""

    def __init__(self, lines: bytes):
        ranks = {}
        for line in lines.splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        tokens = sorted(ranks, key=ranks.get)
        if [ranks[t] for t in tokens] != list(range(len(tokens))) or len(tokens) > 1 << 16:
            raise ValueError("ranks must be 0, 1, 2, ... and fit 16 bits")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        left, right, merged = [], [], []
        for token in tokens:
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(ranks[token])
        self._hash(np.array(left, np.uint32), np.array(right, np.uint32), np.array(merged, np.int32))

    def _hash(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        size = 1 << int(np.ceil(np.log2(4 * len(merged) + 4)))
        self.shift = np.uint32(32 - int(np.log2(size)))
        self.mask = np.uint32(size - 1)
        self.keys = np.full(size, 0xFFFFFFFF, dtype=np.uint32)  # no pair: ids end below 2**16 - 1
        self.values = np.full(size, NONE, dtype=np.int32)
        keys = (left << np.uint32(16)) | right
        slots = self._slots(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = self.keys[slots] == 0xFFFFFFFF
            self.keys[slots[free]] = keys[free]  # of several, the last stays
            done = self.keys[slots] == keys
            self.values[slots[done]] = merged[done]
            keys, merged = keys[~done], merged[~done]
            slots = (slots[~done] + np.uint32(1)) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(2654435761)) >> self.shift

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair put together, NONE where that is no token or a side is padding."""
        keys = (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[at]
        flat = out.reshape(-1)
        slots = self._slots(keys)
        for _ in range(self.probes):
            found = self.keys[slots]
            hit = found == keys
            flat[at[hit]] = self.values[slots[hit]]
            more = ~hit & (found != 0xFFFFFFFF)
            if not more.any():
                break
            at, keys, slots = at[more], keys[more], (slots[more] + np.uint32(1)) & self.mask
        return flat.reshape(out.shape)

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(parts)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        low, high = 0, 4
        while low < LONGEST_ROW:
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            step = max(1, CELLS // high)
            for first in range(0, len(rows), step):
                self._matrix(parts, rows[first : first + step], sizes, high, out)
            low, high = high, high * 2
        for row in np.flatnonzero(sizes > LONGEST_ROW):
            out[row] = self._long(parts[row])
        return out

    def _matrix(self, parts, rows, sizes, width, out) -> None:
        lengths = sizes[rows]
        inside = np.arange(width) < lengths[:, None]
        ids = np.full(inside.shape, -1, dtype=np.int32)
        joined = b"".join([parts[r] for r in rows])
        ids[inside] = self.single[np.frombuffer(joined, np.uint8)]
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
        places = np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            best = ranks[line, at]
            done = best == NONE
            if done.any():
                for i in np.flatnonzero(done):
                    out[rows[i]] = ids[i, : lengths[i]].astype("<u4").tobytes()
                keep = ~done
                rows, ids, ranks, lengths = rows[keep], ids[keep], ranks[keep], lengths[keep]
                at, best = at[keep], best[keep]
                line = line[: len(rows)]
                if not len(rows):
                    return
                fits = int(lengths.max())
                if fits <= width // 2:
                    width = fits
                    ids, ranks, places = ids[:, :width], ranks[:, :width], places[:width]
            ids[line, at] = best
            source = np.minimum(places + (places > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            source = np.minimum(places + (places >= at[:, None]), width - 1)
            ranks = np.take_along_axis(ranks, source, axis=1)
            lengths = lengths - 1
            ids[line, lengths] = -1
            ranks[line, lengths - 1] = NONE
            behind = np.minimum(at + 1, width - 1)
            ranks[line, at] = self.pairs(ids[line, at], np.where(behind > at, ids[line, behind], -1))
            some = np.flatnonzero(at > 0)
            ranks[some, at[some] - 1] = self.pairs(ids[some, at[some] - 1], ids[some, at[some]])

    def _long(self, part: bytes) -> bytes:
        """One long pre-token: pairs wait in a heap by rank and place."""
        ids = self.single[np.frombuffer(part, np.uint8)]
        n = len(ids)
        first = self.pairs(ids[:-1], ids[1:])
        heap = [(int(first[i]), int(i)) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        ids = ids.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = first.tolist() + [int(NONE)]

        def renew(i: int) -> None:
            rank[i] = int(NONE)
            if i >= 0 and after[i] < n:
                got = self.pairs(np.array([ids[i]]), np.array([ids[after[i]]]))
                rank[i] = int(got[0])
                if rank[i] != NONE:
                    heapq.heappush(heap, (rank[i], i))

        while heap:
            best, i = heapq.heappop(heap)
            if rank[i] != best:
                continue
            gone = after[i]
            ids[i], rank[gone] = best, int(NONE)
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        kept, i = [], 0
        while i < n:
            kept.append(ids[i])
            i = after[i]
        return np.array(kept, dtype="<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from the table of all tokens."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[np.arange(total) + shift].tobytes()


def encode_texts(docs: DataFrame, ranks: str, pattern: str, decode: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids), one row per row of ``docs``; with ``decode`` also ``decoded``.

    ``ids`` holds little-endian 32-bit integers. ``ranks`` is the path of a
    .tiktoken file on the driver, broadcast as arrays of a few MB. Null and
    empty texts have no tokens. Ids may be null or repeated; other columns are
    not read.
    """
    with open(ranks, "rb") as file:
        shared = shipped(docs.sparkSession, Ranks(file.read()))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = SCHEMA + (", decoded binary" if decode else "")
    return rows.mapInArrow(_encoder(shared, pattern, decode), schema)


def with_tokens(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """The rows of ``docs``, all columns, with ``n_tokens``, ``ids`` and ``decoded_sha256``.

    A column of ``docs`` with one of these names gives way.
    """
    with open(ranks, "rb") as file:
        shared = shipped(docs.sparkSession, Ranks(file.read()))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]).alias("doc_id")
    rows = docs.select(whole)  # the text is read from the row itself
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary"
    coded = rows.mapInArrow(_encoder(shared, pattern, True), schema)
    return coded.select("doc_id.*", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


def _encoder(shared, pattern: str, decode: bool) -> Callable:
    """Of rows (doc_id, text), or of whole rows that hold a text, with their ids behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        ranks = opened(shared)
        split = regex.compile(pattern).findall
        known: dict[str, bytes] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = some.column(1) if some.num_columns > 1 else pc.struct_field(some.column(0), "text")
                parts = [split(text) if text else [] for text in texts.to_pylist()]
                new = list(set(chain.from_iterable(parts)).difference(known))
                found = dict(zip(new, ranks.encode([p.encode() for p in new])))
                if len(known) > CACHE_TOKENS:
                    known = {}
                known.update((k, v) for k, v in found.items() if len(k) <= LONGEST_KEY)
                ids = [_joined(p, known, found, ranks) for p in parts]
                columns = [
                    some.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                names = ["doc_id", "n_tokens", "ids"]
                if decode:
                    texts = [ranks.decode(np.frombuffer(x, "<u4").astype(np.int64)) for x in ids]
                    columns.append(pa.array(texts, pa.binary()))
                    names.append("decoded")
                yield pa.record_batch(columns, names=names)

    return gives_back(run)


def _joined(parts: list[str], known: dict, found: dict, ranks: Ranks) -> bytes:
    try:
        return b"".join(map(known.__getitem__, parts))
    except KeyError:  # long pre-tokens, and those that left with a full cache
        gone = {p for p in parts if p not in known and p not in found}
        if gone:
            found.update(zip(gone, ranks.encode([p.encode() for p in gone])))
        return b"".join([known[p] if p in known else found[p] for p in parts])


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded texts."""
    coded = encode_texts(docs, ranks, pattern, decode=True)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

