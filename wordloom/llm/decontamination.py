"""Benchmark passages in documents, found by an FM-index for each training shard.

A shard is some hundred thousand words of the documents of one task. Only runs
of words that all occur in the benchmark, and are long enough for its shortest
window, are indexed; no other word can be inside an occurrence. The index is
the Burrows-Wheeler transform of the runs in a wavelet matrix, with suffix
positions sampled. All windows search backwards at once; occurrences are
located, and the words they cover become spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.texts import LOWER, blocks, gives_back, word_hashes, words_of
from wordloom.scratch import use_shared_checkpoints

WINDOW = 10
BENCHMARK_BYTES = 32 * 1024 * 1024  # broadcast at once; a larger benchmark is searched in blocks
SHARD_SYMBOLS = 400_000
SHARD_BYTES = 16 * 1024 * 1024
SAMPLED = 8  # every so many positions of a run keep their place

# Fixed value: bytes that are no part of a word, [\x00-\x2F\x3A-\x60\x7B-\x7F].
NOT_WORD = np.zeros(256, dtype=bool)
NOT_WORD[0x00:0x30] = NOT_WORD[0x3A:0x61] = NOT_WORD[0x7B:0x80] = True

SPAN = "struct<first: bigint, last: bigint, start: bigint, end: bigint>"
HITS = f"struct<n_words: bigint, spans: array<{SPAN}>, items: array<string>>"


class Windows:
    """The windows of a block of the benchmark over a small alphabet of its words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        batch = pa.record_batch([pa.array([t for _, t in items], pa.string())], names=["text"])
        owners: dict[tuple[int, ...], set[str]] = {}
        for rows, data, offsets in blocks(iter([batch]), limit=2**30):
            data = LOWER[data]
            starts, ends, first = words_of(data, offsets, NOT_WORD)
            hashes = word_hashes(data, starts, ends)
            self.vocabulary, symbols = np.unique(hashes, return_inverse=True)
            symbols = symbols + 1
            for row in range(rows.num_rows):
                own = symbols[first[row] : first[row + 1]].tolist()
                for at in range(max(1, len(own) - size + 1) if own else 0):
                    owners.setdefault(tuple(own[at : at + size]), set()).add(items[row][0])
        found = sorted(owners)
        self.lengths = np.array([len(w) for w in found], dtype=np.int64)
        self.symbols = np.zeros((len(found), size), dtype=np.int64)  # aligned to the right
        for row, window in enumerate(found):
            self.symbols[row, size - len(window) :] = window
        self.items = [sorted(owners[w]) for w in found]
        self.shortest = int(self.lengths.min()) if len(found) else 0

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's symbol, 0 for words the benchmark lacks."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


class FmIndex:
    """Backward search and location in a sequence of symbols, where 0 parts the runs."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = _suffixes(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.levels = max(1, int(text.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        level = before
        for bit in range(self.levels - 1, -1, -1):
            one = (level >> bit) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(one)]).astype(np.int32))
            self.zeros.append(n - int(one.sum()))
            level = np.concatenate([level[one == 0], level[one == 1]])
        self.begin = np.searchsorted(np.sort(text), np.arange((1 << self.levels) + 1))
        self.before, self.n = before, n
        # Places known without a walk: starts of runs, and every SAMPLED-th position.
        self.place = np.where((before == 0) | (order % SAMPLED == 0), order, -1)

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often the symbol stands in front of the first ``end`` suffixes."""
        low = np.zeros_like(end)
        for bit, ones, zeros in zip(range(self.levels - 1, -1, -1), self.ones, self.zeros):
            one = ((symbol >> bit) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - low

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each window."""
        count = len(windows.lengths)
        low, high = np.zeros(count, np.int64), np.full(count, self.n, np.int64)
        width = windows.symbols.shape[1]
        for step in range(1, width + 1):
            at = np.flatnonzero((windows.lengths >= step) & (high > low))
            symbol = windows.symbols[at, width - step]
            known = symbol < len(self.begin) - 1
            high[at[~known]] = low[at[~known]]
            at, symbol = at[known], symbol[known]
            low[at] = self.begin[symbol] + self.rank(symbol, low[at])
            high[at] = self.begin[symbol] + self.rank(symbol, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: walk to the next place that is kept."""
        out, back = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        left, rows = np.arange(len(rows)), rows.copy()
        while len(left):
            known = self.place[rows] >= 0
            out[left[known]] = self.place[rows[known]] + back[left[known]]
            left, rows = left[~known], rows[~known]
            symbol = self.before[rows]
            rows = self.begin[symbol] + self.rank(symbol, rows)
            back[left] += 1
        return out


def _suffixes(text: np.ndarray) -> np.ndarray:
    """The suffix array, by doubling. Every 0 counts as a symbol of its own."""
    n = len(text)
    parts = text == 0
    rank = np.where(parts, np.cumsum(parts) - 1, text + int(parts.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    order, step = np.argsort(rank, kind="stable"), 1
    while n and rank.max() < n - 1:
        behind = np.zeros(n, dtype=np.int64)
        behind[:-step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2
    return order


class Shard:
    """Texts of a task gathered until there are enough for an index."""

    def __init__(self, windows: Windows):
        self.windows = windows
        self.clear()

    def clear(self) -> None:
        self.rows, self.symbols, self.words, self.owner = [], [], [], []
        self.starts, self.ends, self.counts = [], [], []
        self.n_symbols = self.n_bytes = self.n_texts = 0

    def add(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        data = LOWER[data]
        starts, ends, first = words_of(data, offsets, NOT_WORD)
        row = np.repeat(np.arange(rows.num_rows), np.diff(first))
        self.counts.append(np.diff(first))
        if self.windows.shortest and len(starts):
            symbols = self.windows.of_words(word_hashes(data, starts, ends))
            inside = symbols > 0
            new = np.ones(len(symbols), dtype=bool)
            new[1:] = (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
            run = np.cumsum(new) - 1
            kept = inside & (np.bincount(run)[run] >= self.windows.shortest)
            # A run that begins takes a 0 in front.
            at = np.flatnonzero(kept)
            where = np.arange(len(at)) + np.cumsum(new[at])
            size = len(at) + int(new[at].sum())
            text, word = np.zeros(size, np.int64), np.full(size, -1, np.int64)
            text[where], word[where] = symbols[at], at - first[row[at]]
            owner, start, end = (np.zeros(size, np.int64) for _ in range(3))
            owner[where] = row[at] + self.n_texts
            start[where], end[where] = (x[at] - offsets[row[at]] for x in (starts, ends))
            for held, part in zip(
                (self.symbols, self.words, self.owner, self.starts, self.ends),
                (text, word, owner, start, end),
            ):
                held.append(part)
            self.n_symbols += size
        self.rows.append(rows)
        self.n_bytes += len(data)
        self.n_texts += rows.num_rows

    def full(self) -> bool:
        return self.n_symbols >= SHARD_SYMBOLS or self.n_bytes >= SHARD_BYTES

    def hits(self) -> tuple[np.ndarray, dict[int, list], dict[int, set]]:
        """Words of each text; by text, its spans and the items found in it."""
        spans: dict[int, list] = {}
        items: dict[int, set] = {}
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        if not self.n_symbols:
            return counts, spans, items
        text, word, owner, start, end = (
            np.concatenate([*x, np.zeros(1, np.int64)])
            for x in (self.symbols, self.words, self.owner, self.starts, self.ends)
        )
        index = FmIndex(text)
        low, high = index.search(self.windows)
        size = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(size)), size)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        places = index.locate(rows)
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + self.windows.lengths[which], -1)
        hit = np.cumsum(cover[:-1]) > 0
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            spans.setdefault(int(owner[a]), []).append(
                (int(word[a]), int(word[b - 1]) + 1, int(start[a]), int(end[b - 1]))
            )
        count = len(self.windows.lengths)
        for pair in np.unique(owner[places] * count + which).tolist():
            items.setdefault(pair // count, set()).update(self.windows.items[pair % count])
        return counts, spans, items


def _merged(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[list[int]] = []
    for span in sorted(spans):
        if out and span[0] <= out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1][1], out[-1][3] = span[1], span[3]
        else:
            out.append(list(span))
    return [tuple(x) for x in out]


def _searcher(shared, size: int, column: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(Windows(shared.value, size))

        def flush() -> Iterator[pa.RecordBatch]:
            counts, spans, items = shard.hits()
            at = 0
            for rows in shard.rows:
                hits = []
                for i, old in enumerate(rows.column(column).to_pylist()):
                    old = old or {"spans": [], "items": []}
                    own = _merged(
                        spans.get(at + i, [])
                        + [(s["first"], s["last"], s["start"], s["end"]) for s in old["spans"]]
                    )
                    hits.append(
                        {
                            "n_words": int(counts[at + i]),
                            "spans": [dict(zip(("first", "last", "start", "end"), s)) for s in own],
                            "items": sorted(items.get(at + i, set()).union(old["items"])),
                        }
                    )
                at += rows.num_rows
                place = rows.schema.get_field_index(column)
                kind = rows.schema.field(place).type
                arrays = list(rows.columns)
                arrays[place] = pa.array(hits, kind)
                yield pa.RecordBatch.from_arrays(arrays, names=rows.schema.names)
            shard.clear()

        for rows, data, offsets in blocks(batches):
            shard.add(rows, data, offsets)
            if shard.full():
                yield from flush()
        yield from flush()

    return gives_back(run)


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    column: str = "hits",
    window: int = WINDOW,
    block_bytes: int = BENCHMARK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` as they are, with a column of what the benchmark has in common.

    ``hits.spans`` holds merged runs of covered words: [first, last) in words
    and [start, end) in bytes of the UTF-8 text. ``hits.items`` are the ids, as
    strings, of items of which some window occurs; a null id is written "null",
    items that share an id count once. Null and empty texts have no words.
    ``column`` must be no column of ``docs``, which may have any others.

    The benchmark is measured, and cut into blocks of ``block_bytes`` by a hash
    of its rows; each block is one pass over the documents. A word is known by a
    64-bit hash.
    """
    if column in docs.columns:
        raise ValueError(f"{column} is a column of the documents already")
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = items.agg(F.sum(F.octet_length("text") + 32).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-int(size) // block_bytes))
    found = docs.withColumn(column, F.lit(None).cast(HITS))
    for block in range(n_blocks):
        if block:
            use_shared_checkpoints(docs.sparkSession)
            found = found.checkpoint()
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        rows = [(r["item_id"], r["text"]) for r in part.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(rows)
        found = found.mapInArrow(_searcher(shared, window, column), found.schema)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated), one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    covered = F.aggregate(
        "hits.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"]
    )
    return with_hits(rows, benchmark, window=window).select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        covered.alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        F.col("hits.items").alias("items"),
        (covered > 0).alias("contaminated"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with the covered spans cut out of ``text``; other columns stay.

    A text without a hit stays as it is, null included.
    """
    column = "hits"
    while column in docs.columns:
        column += "_"
    found = with_hits(docs, benchmark, column, window)
    raw = F.encode("text", "UTF-8")
    spans = F.col(f"{column}.spans")
    # Parts before each span, then the part behind the last one.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length("text").cast("bigint")))
    parts = F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda p: F.decode(
            F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")), "UTF-8"
        ),
    )
    text = F.when(F.size(spans) > 0, F.array_join(parts, "")).otherwise(F.col("text"))
    return found.withColumn("text", text).drop(column)
