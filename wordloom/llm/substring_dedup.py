"""Removal of repeated word sequences by prefix-partitioned suffix trees.

Suffixes start at the anchors of ``repeats``. They are dealt out by a prefix of
variable length: as few words as keep the suffixes of a group within a bound.
Each group is a subtree of the suffix tree, built in one task. The suffixes
below an internal node share its depth in words; below deep nodes, whole
windows are equal if the words before the anchor are, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.repeats import (
    LARGE_GROUP,
    SPANS,
    Rule,
    by_document,
    found_segments,
    merged_runs,
    removed_spans,
)
from wordloom.llm.suffix_dedup import _lists
from wordloom.llm.texts import blocks, words_of
from wordloom.operators.joins import fits_broadcast, salted_join
from wordloom.scratch import use_shared_checkpoints

WINDOW, GRAM = 50, 12
PREFIXES = (2, 4, 8)  # words; then the whole anchor

Words = list[bytes]


class Node:
    """A node of a suffix tree: its depth in words, a suffix that spells it, what is below."""

    __slots__ = ("depth", "spelled", "children", "entries")

    def __init__(self, depth: int, spelled: Words):
        self.depth, self.spelled = depth, spelled
        self.children: dict[bytes, Node] = {}
        self.entries: list[tuple] = []  # suffixes that end here


def insert(root: Node, suffix: Words, entry: tuple) -> None:
    node, at = root, 0
    while at < len(suffix):
        child = node.children.get(suffix[at])
        if child is None:
            child = node.children[suffix[at]] = Node(len(suffix), suffix)
            child.entries.append(entry)
            return
        j = at
        while j < child.depth and j < len(suffix) and child.spelled[j] == suffix[j]:
            j += 1
        if j < child.depth:
            middle = Node(j, suffix)
            middle.children[child.spelled[j]] = child
            node.children[suffix[at]] = child = middle
        node, at = child, j
    node.entries.append(entry)


def repeated_windows(root: Node, rule: Rule) -> Iterator[tuple[tuple, int]]:
    """(entry, d) for windows that occur in an earlier document; a window starts d words before.

    An entry is (id, text, start of its segment, words before the anchor, number
    of windows). A window at distance d takes its other words from the suffix, so
    it is looked for at the node whose edge reaches that depth.
    """

    def below(node: Node, above: int) -> Iterator[tuple[tuple, int]]:
        held = list(node.entries)
        for child in node.children.values():
            held += yield from below(child, node.depth)
        if len(held) > 1:
            least = min(len(e[3]) - e[4] + 1 for e in held)
            for d in range(max(least, rule.window - node.depth), rule.window - above):
                first: dict[tuple, int] = {}
                members = []
                for e in held:
                    left, n = e[3], e[4]
                    if len(left) - n < d <= len(left):
                        window = tuple(left[len(left) - d :])
                        if first.setdefault(window, e[0]) > e[0]:
                            first[window] = e[0]
                        members.append((e, window))
                if len(first) < len(members):
                    for e, window in members:
                        if e[0] > first[window]:
                            yield e, d
        return held

    yield from below(root, 0)


def _subtrees(rule: Rule) -> Callable:
    """Spans of repeated windows from passages sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, root, size = None, Node(0, []), 0

        def flush() -> Iterator[pa.RecordBatch]:
            found = []
            if size > 1:
                for (key, text, start, left, _), d in repeated_windows(root, rule):
                    at = start + len(left) - d
                    found.append((key, text, at, at + rule.window))
            if found:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                yield pa.record_batch(
                    [pa.array(x, k) for x, k in zip(zip(*found), kinds)],
                    names=[f.split()[0] for f in SPANS.split(", ")],
                )

        names = ("group", "_id", "_h", "start", "off", "n", "passage")
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                own, key, text, start, off, n, passage = row
                if own != group:
                    yield from flush()
                    group, root, size = own, Node(0, []), 0
                words = passage.split(b" ")
                insert(root, words[off:], (key, text, start, words[:off], n))
                size += 1
        yield from flush()

    return run


def _kept(rows: DataFrame) -> DataFrame:
    use_shared_checkpoints(rows.sparkSession)
    return rows.checkpoint()


def repeated_spans(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, large: int = LARGE_GROUP
) -> DataFrame:
    """(_id, _h, spans) of the documents with repeated word sequences; ``texts`` from by_document."""
    rule = Rule("word", window, gram, own=False, prefixes=tuple(p for p in PREFIXES if p < gram))

    def grouped(rows: DataFrame) -> DataFrame:
        """The shortest prefix that at most ``large`` suffixes have, or else the anchor.

        There are few long lists of suffixes, so these prefixes come to the rows.
        """
        group = F.col("h1")
        for length in reversed(rule.prefixes):
            prefix = f"p{length}"
            many = rows.groupBy(prefix).agg(F.count("*").alias("m")).where(F.col("m") > large)
            many = _kept(many.select(prefix, F.lit(True).alias(f"long{length}")))
            if fits_broadcast(many):
                rows = rows.join(F.broadcast(many), prefix, "left")
            else:
                rows = salted_join(rows, many, [prefix], "left", ["_id", "start"])
            group = F.when(F.col(f"long{length}").isNull(), F.col(prefix)).otherwise(group)
        return rows.withColumn("group", group)

    def resolve(passages: DataFrame) -> DataFrame:
        dealt = passages.repartition("group").sortWithinPartitions("group", "h1")
        return dealt.mapInArrow(_subtrees(rule), SPANS)

    return removed_spans(texts, found_segments(texts, rule), rule, grouped, resolve, large)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in blocks(batches):
        starts, ends, first = words_of(data, offsets)
        row, start, end = merged_runs(_lists(batch.column("spans")))
        edge = np.zeros(len(starts) + 1, dtype=np.int64)
        np.add.at(edge, first[row] + start, 1)
        np.add.at(edge, first[row] + end, -1)
        keep = np.cumsum(edge)[:-1] == 0
        # Kept words with one space behind each, gathered byte by byte.
        sizes = (ends - starts + 1)[keep]
        stops = np.cumsum(sizes)
        shift = np.repeat(starts[keep] - (stops - sizes), sizes)
        at = np.arange(len(shift)) + shift
        joined = np.concatenate([data, np.zeros(1, np.uint8)])[at]
        joined[stops - 1] = 0x20
        joined = joined.tobytes()
        ends_at = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(keep)])[first]]
        parts = [joined[a : max(a, b - 1)] for a, b in zip(ends_at[:-1].tolist(), ends_at[1:].tolist())]
        n = np.diff(first)
        left = np.diff(np.concatenate([[0], np.cumsum(keep)])[first])
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(n.astype(np.int64)),
                pa.array((n - left).astype(np.int64)),
                pa.array(parts, pa.binary()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def without_repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per row of ``docs``.

    Each word is removed that is in a window of ``window`` consecutive words
    which also starts in a document with a smaller doc_id; null is the smallest.
    ``kept`` is the other words, joined by one space, as UTF-8. Null texts have no
    words; texts shorter than a window lose none. Rows that share an id do not
    count as smaller to each other. Other columns are not read.
    """
    texts = by_document(docs)
    spans = repeated_spans(texts, window, gram)
    rows = texts.join(spans, ["_id", "_h"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(_cut, "doc_id bigint, n_words bigint, n_removed bigint, kept binary")
