"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Suffixes start at the anchors of ``repeats``; each carries what stands before
it. Tasks sort their suffixes into runs, front-coded: a suffix is the length it
shares with the one before and the rest. Runs are exchanged by range of the
anchor's hash and merged by a loser tree that knows how much each contender
shares with the last winner, so bytes known to be equal are never compared
again. In the merged order equal windows are next to each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.repeats import (
    SEGMENT,
    SPANS,
    Rule,
    by_document,
    found_segments,
    merged_runs,
    removed_spans,
)
from wordloom.llm.texts import NULL_ID, blocks

WINDOW, GRAM = 100, 32
BUCKET_SUFFIXES = 8_192  # merged at once, on average
RUN_BYTES = 32 * 1024 * 1024  # of passages sorted at once by a task

RUNS = (
    "bucket bigint, lcps array<int>, rests array<binary>, lefts array<binary>, ids array<bigint>,"
    " texts array<bigint>, starts array<int>, counts array<int>"
)


def _shared(a: bytes, b: bytes, known: int) -> int:
    """How many first bytes are equal, of which ``known`` are known to be."""
    size = min(len(a), len(b))
    if a[known:size] == b[known:size]:
        return size
    low, high = known, size  # a[:low] is equal, a[:high] is not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_coded(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted suffixes, the length shared with the one before and the rest."""
    lcps, rests, last = [], [], b""
    for suffix in suffixes:
        n = _shared(last, suffix, 0)
        lcps.append(n)
        rests.append(suffix[n:])
        last = suffix
    return lcps, rests


def merge(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, bytes, int]]:
    """(run, place, suffix, length shared with the last) of front-coded runs, in order.

    Each contender knows the length it shares with the last winner. Of two, the
    one that shares more is less; only at equal lengths are bytes compared, from
    there on.
    """
    n = len(runs)
    suffix = [rests[0] if rests else None for _, rests in runs]
    share = [0] * n
    place = [0] * n
    size = 1
    while size < n:
        size *= 2
    losers = [-1] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        if a < 0 or suffix[a] is None:
            return b, a
        if b < 0 or suffix[b] is None:
            return a, b
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        x, y = suffix[a], suffix[b]
        k = _shared(x, y, share[a])
        if k == len(x) or (k < len(y) and x[k] < y[k]):
            share[b] = k
            return a, b
        share[a] = k
        return b, a

    def first(node: int) -> int:
        if node >= size:
            return node - size if node - size < n else -1
        winner, losers[node] = play(first(2 * node), first(2 * node + 1))
        return winner

    winner = first(1) if n else -1
    while winner >= 0 and suffix[winner] is not None:
        lcps, rests = runs[winner]
        at = place[winner]
        yield winner, at, suffix[winner], share[winner]
        at += 1
        place[winner] = at
        if at < len(rests):
            share[winner] = lcps[at]
            suffix[winner] = suffix[winner][: lcps[at]] + rests[at]
        else:
            suffix[winner] = None
        node = (size + winner) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


# A suffix in the merged order: (document, text, start of its segment), what
# stands before it, and how many windows its segment has.
Entry = tuple[tuple[int, int, int], bytes, int]


def repeated_windows(
    group: list[Entry], lcps: list[int], rule: Rule
) -> Iterator[tuple[Entry, int]]:
    """(entry, d) for windows that occur earlier; a window starts d bytes before its anchor.

    ``group`` holds the suffixes of one anchor in order. Windows at distance d
    are equal where the suffixes share the rest of the window, and the d bytes
    before them are equal.
    """
    low = min(len(left) - n + 1 for _, left, n in group)
    high = max(len(left) for _, left, _ in group)
    for d in range(low, high + 1):
        rest, run = rule.window - d, 0
        least: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        members = []
        for entry, lcp in zip(group, lcps):
            run += lcp < rest
            key, left, n = entry
            if len(left) - n < d <= len(left):
                window = (run, left[len(left) - d :])
                start = (key[0], key[1], key[2] + len(left) - d)
                if window not in least or start < least[window]:
                    least[window] = start
                members.append((entry, window, start))
        if len(least) < len(members):
            for entry, window, start in members:
                first = least[window]
                if start > first if rule.own else start[0] > first[0]:
                    yield entry, d


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[] for _ in range(8)]
        for bucket, rows in held.items():
            rows.sort()
            suffixes, lefts, ids, texts, starts, counts = (list(x) for x in zip(*rows))
            lcps, rests = front_coded(suffixes)
            for c, x in zip(columns, (bucket, lcps, rests, lefts, ids, texts, starts, counts)):
                c.append(x)
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.list_(pa.binary())]
        kinds += [pa.list_(pa.int64())] * 2 + [pa.list_(pa.int32())] * 2
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=[f.split()[0] for f in RUNS.split(", ")],
        )
        held.clear()

    for batch in batches:
        names = ("group", "passage", "off", "_id", "_h", "start", "n")
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            bucket, passage, off, *rest = row
            held.setdefault(bucket, []).append((passage[off:], passage[:off], *rest))
            size += len(passage) + 100
            if size > RUN_BYTES:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def _merged_buckets(rule: Rule) -> Callable:
    def spans_of(runs: list[dict]) -> Iterator[tuple[int, int, int, int]]:
        group: list[Entry] = []
        lcps: list[int] = []

        def close() -> Iterator[tuple[int, int, int, int]]:
            if len(group) > 1:
                for (key, left, _), d in repeated_windows(group, lcps, rule):
                    start = key[2] + len(left) - d
                    yield key[0], key[1], start, start + rule.window

        for run, at, _, lcp in merge([(r["lcps"], r["rests"]) for r in runs]):
            r = runs[run]
            if lcp < rule.gram:
                yield from close()
                group, lcps = [], []
            group.append(((r["ids"][at], r["texts"][at], r["starts"][at]), r["lefts"][at], r["counts"][at]))
            lcps.append(lcp if len(group) > 1 else 0)
        yield from close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, runs = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            found = list(spans_of(runs)) if runs else []
            if found:
                ids, texts, starts, ends = zip(*found)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.record_batch(
                    [pa.array(x, k) for x, k in zip((ids, texts, starts, ends), kinds)],
                    names=[f.split()[0] for f in SPANS.split(", ")],
                )

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    yield from flush()
                    bucket, runs = row["bucket"], []
                runs.append(row)
        yield from flush()

    return run


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(_id, _h, spans) of the documents with repeated byte strings; ``texts`` from by_document."""
    rule = Rule("byte", window, gram, own=True)
    found = found_segments(texts, rule)
    count = found.where(F.col("kind") == SEGMENT).count()
    buckets = max(1, count // BUCKET_SUFFIXES)

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.withColumn("group", F.pmod(F.xxhash64("h1"), F.lit(buckets)))

    def resolve(passages: DataFrame) -> DataFrame:
        runs = passages.mapInArrow(_sorted_runs, RUNS)
        runs = runs.repartition("bucket").sortWithinPartitions("bucket")
        return runs.mapInArrow(_merged_buckets(rule), SPANS)

    return removed_spans(texts, found, rule, grouped, resolve)


def _cut() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in blocks(batches):
            row, start, end = merged_runs(_lists(batch.column("spans")))
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            np.add.at(edge, offsets[row] + start, 1)
            np.add.at(edge, offsets[row] + end, -1)
            keep = np.cumsum(edge)[:-1] == 0
            kept = data[keep].tobytes()
            sizes = np.concatenate([[0], np.cumsum(keep)])[offsets]
            n = np.diff(offsets)
            left = np.diff(sizes)
            spans = np.bincount(row, minlength=batch.num_rows)
            parts = [kept[a:b] for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist())]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    *(pa.array(x.astype(np.int64)) for x in (n, n - left, spans)),
                    pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def _lists(column: pa.Array) -> pa.ListArray:
    """The list column with empty lists for nulls."""
    if column.null_count:
        rows = [x or [] for x in column.to_pylist()]
        return pa.array(rows, column.type)
    return column


def without_repeated_bytes(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of ``docs``.

    Of the UTF-8 text each byte is removed that a ``window``-byte string covers
    which also starts earlier: in a document before in the order of (doc_id, hash
    of the text), null ids first, or earlier in the same one. ``kept`` is what
    remains, bytes. Null and short texts lose nothing. Rows that repeat id and
    text are one document and share its result; a text repeated under the same
    id is no earlier document. Other columns are not read.
    """
    texts = by_document(docs)
    spans = repeated_spans(texts, window, gram)
    rows = texts.join(spans, ["_id", "_h"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(
        _cut(), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def with_repeats_cut(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated byte strings cut out of ``text``.

    A character that a cut would part stays whole. A text that loses nothing
    stays as it is, null included.
    """
    spans = repeated_spans(by_document(docs), window, gram)
    names = {}
    for name in ("_id", "_h", "spans"):
        names[name] = name
        while names[name] in docs.columns:
            names[name] += "_"
    keyed = docs.withColumns(
        {
            names["_id"]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)),
            names["_h"]: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        }
    )
    on = [names["_id"], names["_h"]]
    joined = keyed.join(spans.withColumnsRenamed(names), on, "left").drop(*on)
    cut = joined.mapInArrow(_cut_texts(names["spans"]), joined.schema)
    return cut.select(docs.columns)


def _cut_texts(column: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, end = merged_runs(_lists(batch.column(column)))
            place = batch.schema.get_field_index("text")
            texts = batch.column(place).to_pylist()
            cut: dict[int, list[tuple[int, int]]] = {}
            for r, a, b in zip(row.tolist(), start.tolist(), end.tolist()):
                cut.setdefault(r, []).append((a, b))
            for r, runs in cut.items():
                raw, at, parts = texts[r].encode(), 0, []
                for a, b in runs:
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                    parts.append(raw[at:a])
                    at = b
                texts[r] = b"".join([*parts, raw[at:]]).decode()
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run
