"""Repeated passages: from all documents to the few places where suffixes must be compared.

A passage is a window of symbols, words or bytes, of fixed length. Each window
has an anchor: of the shorter grams in it, the one with the least hash. Equal
windows have equal anchors at equal offsets, so only suffixes that start at
anchors need a place in a suffix structure. Consecutive windows with the same
anchor form a segment, and a segment is described by hashes of its anchor and of
its whole content:

* an anchor that occurs once has no repeated window;
* of equal segments all windows repeat, whatever else there is, so one stays
  and the others are removed at once, most of them before any shuffle;
* different segments with the same anchor share some windows or none. Only
  these, the ends of passages and the surroundings of edits, are compared.

An anchor may be in a third of all texts, each time in other surroundings. A
task that has many segments of an anchor deals them by their content, as salt,
and tells the anchor's own place by one row that there are several. Where only
other documents count, a document that says the same over and over is compared
once: its further segments are copies, which lose what the first one loses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.texts import (
    BASE,
    BLOCK_BYTES,
    BYTE_CODE,
    INVERSE,
    blocks,
    give_back,
    identified,
    mixed,
    powers,
    word_hashes,
    words_of,
)
from wordloom.scratch import new_path

TILE = 1 << 22  # window starts handled at once; anchors keep their place in 24 bits
# Segments, 52 bytes each, that a task remembers to remove repeats before the shuffle.
TASK_SEGMENTS = 500_000
SYMBOL_BYTES = {"word": 1, "byte": 4}  # a block's arrays have one place a symbol, so shorter blocks of bytes
LARGE_GROUP = 20_000  # segments of one anchor; beyond, windows are grouped one by one
TASK_ANCHOR = 64  # segments of one anchor that a task deals by the anchor; beyond, by their content

PLACES = "h1 bigint, h2 bigint, _id bigint, _h bigint, start int, off int, n int"
KINDS = f"kind tinyint, salt bigint, {PLACES}"
# SEVERAL tells that an anchor has other contents, which are dealt elsewhere. COPY is
# a segment that repeats one of its own document, which starts at ``off``.
REMOVED, SEGMENT, SEVERAL, COPY = 0, 1, 2, 3


@dataclass(frozen=True)
class Rule:
    """What repeats. ``own`` tells whether a document's own earlier windows count."""

    unit: str  # "word" or "byte"
    window: int
    gram: int
    own: bool
    prefixes: tuple[int, ...] = ()  # lengths of further hashes of what an anchor begins with


def symbols_of(rule: Rule, data: np.ndarray, offsets: np.ndarray):
    """(codes, first, starts, ends): a 64-bit code per symbol; starts and ends only of words."""
    if rule.unit == "byte":
        return BYTE_CODE[data], offsets, None, None
    starts, ends, first = words_of(data, offsets)
    return word_hashes(data, starts, ends), first, starts, ends


class Hashes:
    """Hashes of any stretch of a sequence of codes, from one running sum."""

    def __init__(self, codes: np.ndarray):
        self.sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(codes * powers(BASE, len(codes)), dtype=np.uint64, out=self.sums[1:])
        self.back = powers(INVERSE, len(codes) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(value ^ (end - start).astype(np.uint64))


def segments(rule: Rule, codes: np.ndarray, first: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """The segments of all texts of a block, in tiles of window starts."""
    w = rule.window - rule.gram + 1
    for low in range(0, max(len(codes) - rule.window + 1, 0), TILE):
        part = codes[low : low + TILE + rule.window - 1]
        hashes = Hashes(part)
        grams = np.arange(len(part) - rule.gram + 1)
        h1 = hashes.of(grams, grams + rule.gram)
        least = (h1 & ~np.uint64(0xFFFFFF)) | grams.astype(np.uint64)
        span = 1
        while span * 2 <= w:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if w > span:
            least = np.minimum(least[: len(least) - (w - span)], least[w - span :])
        anchor = (least & np.uint64(0xFFFFFF)).astype(np.int64)  # of the window at each start
        row = np.searchsorted(first, np.arange(low, low + len(anchor)), side="right") - 1
        inside = np.arange(low, low + len(anchor)) + rule.window <= first[row + 1]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
        begin = np.flatnonzero(new & inside)
        if not len(begin):
            continue
        closes = inside.copy()
        closes[:-1] &= new[1:] | ~inside[1:]
        last = np.flatnonzero(closes)
        at = anchor[begin]
        out = {
            "h1": h1[at],
            "h2": mixed(hashes.of(begin, last + rule.window) + (at - begin).astype(np.uint64)),
            "row": row[begin],
            "start": begin + low - first[row[begin]],
            "off": at - begin,
            "n": last - begin + 1,
        }
        for length in rule.prefixes:
            out[f"p{length}"] = hashes.of(at, at + length)
        yield out


def _schema(rule: Rule, base: str) -> str:
    return ", ".join([base, *(f"p{length} bigint" for length in rule.prefixes)])


def _names(rule: Rule, base: str) -> list[str]:
    return [field.split()[0] for field in _schema(rule, base).split(", ")]


def _batch(columns: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    kinds = {"kind": pa.int8(), "start": pa.int32(), "off": pa.int32(), "n": pa.int32()}
    return pa.record_batch(
        [
            pa.array(columns[c].astype(kinds[c].to_pandas_dtype()), kinds[c])
            if c in kinds
            else pa.array(columns[c].view(np.int64), pa.int64())
            for c in names
        ],
        names=names,
    )


def _each(rows: dict[str, np.ndarray], change: Callable[[np.ndarray], np.ndarray]) -> None:
    """Every column changed in its place."""
    for c in rows:
        rows[c] = change(rows[c])


def _slices(rows: dict[str, np.ndarray], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows["h1"]), 50_000):
        yield _batch({c: x[at : at + 50_000] for c, x in rows.items()}, names)


def _anchored(rule: Rule) -> Callable:
    """The segments of a task's texts; those that repeat within the task are removed already."""
    names = _names(rule, KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if size:
                rows, size = {}, 0
                while held:  # one column after another, so that hardly any is there twice
                    c, pieces = held.popitem()
                    rows[c] = np.concatenate(pieces)
                    del pieces
                order = np.lexsort((rows["start"], rows["_h"], rows["_id"], rows["h2"], rows["h1"]))
                _each(rows, lambda x: x[order])
                later = _repeats(rule, rows)
                gone = _joined_spans(rule, {c: x[later] for c, x in rows.items()})
                yield from _slices(gone, names)
                _each(rows, lambda x: x[~later])
                del order, later, gone
                rows, copies = _without_copies(rows)
                yield from _slices(copies, names)
                del copies
                rows["kind"] = np.full(len(rows["h1"]), SEGMENT, np.int8)
                rows["salt"], several = _salted(rows)
                yield from _slices(rows, names)
                yield from _slices(several, names)

        for part, data, offsets in blocks(batches, limit=BLOCK_BYTES // SYMBOL_BYTES[rule.unit]):
            codes, first, _, _ = symbols_of(rule, data, offsets)
            ids = part.column("_id").to_numpy(zero_copy_only=False)
            texts = part.column("_h").to_numpy(zero_copy_only=False)
            for found in segments(rule, codes, first):
                row = found.pop("row")
                found["_id"], found["_h"] = ids[row], texts[row]
                for c, x in found.items():
                    held.setdefault(c, []).append(x.astype(np.int32) if c in ("start", "off", "n") else x)
                size += len(row)
            if size >= TASK_SEGMENTS:
                yield from flush()
        yield from flush()
        give_back()

    return run


def _joined_spans(rule: Rule, rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Removed segments with those they touch joined to one; hashes only spread them evenly."""
    order = np.lexsort((rows["start"], rows["_h"], rows["_id"]))
    rows = {c: x[order] for c, x in rows.items()}
    size = len(order)
    if size:
        keys = rows["_id"].astype(np.uint64) * np.uint64(BASE) + rows["_h"].astype(np.uint64)
        end = rows["start"] + rows["n"]
        # A document's rows are sorted; ends grow with starts, as segments follow each other.
        new = np.ones(size, dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (rows["start"][1:] > end[:-1])
        last = np.concatenate([np.flatnonzero(new)[1:] - 1, [size - 1]])
        rows = {c: x[new] for c, x in rows.items()}
        rows["n"] = end[last] - rows["start"]
        rows["h1"] = mixed(keys[new] + rows["start"].astype(np.uint64))
    rows["kind"] = np.full(len(rows["h1"]), REMOVED)
    rows["salt"] = np.zeros(len(rows["h1"]), dtype=np.int64)
    return rows


def _without_copies(rows: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Of sorted segments, the first of those equal in a document, and the others as copies of it."""
    keys = [rows[c] for c in ("h1", "h2", "_id", "_h")]
    first = np.ones(len(keys[0]), dtype=bool)
    first[1:] = np.any([x[1:] != x[:-1] for x in keys], axis=0)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    copies = {c: x[~first] for c, x in rows.items()}
    copies["off"] = rows["start"][lead][~first]
    copies["h1"] = mixed(copies["h1"] + copies["start"].astype(np.uint64))  # spreads them evenly
    copies["kind"] = np.full(len(copies["h1"]), COPY)
    copies["salt"] = np.zeros(len(copies["h1"]), dtype=np.int64)
    return {c: x[first] for c, x in rows.items()}, copies


def _salted(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The salt of sorted segments, 0 where their anchor has few, and a row for each that has many.

    Segments dealt by content are all compared.
    """
    h1 = rows["h1"]
    begin = np.flatnonzero(np.concatenate([[True], h1[1:] != h1[:-1]])[: len(h1)])
    counts = np.diff(np.append(begin, len(h1)))
    many = counts > TASK_ANCHOR
    salt = np.where(np.repeat(many, counts), rows["h2"].view(np.int64), np.int64(0))
    several = {c: np.zeros(many.sum(), dtype=x.dtype) for c, x in rows.items()}
    several["salt"] = np.zeros(many.sum(), dtype=np.int64)
    several["h1"] = h1[begin[many]]
    several["kind"] = np.full(many.sum(), SEVERAL)
    return salt, several


def _repeats(rule: Rule, rows: dict[str, np.ndarray], before: tuple | None = None) -> np.ndarray:
    """Of sorted rows, those whose windows all occur earlier, in the first of the equal segments.

    ``before`` is (h1, salt, h2, _id, _h, start) of the first segment equal to
    the first rows, where that came with an earlier batch.
    """
    same = [rows[c] for c in ("h1", "salt", "h2") if c in rows]
    h1 = rows["h1"]
    new = np.ones(len(h1), dtype=bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in same], axis=0)
    keys = [rows[c] for c in ("_id", "_h", "start")]
    lead = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))
    leads = [k[lead] for k in keys]
    if before is not None and len(h1) and tuple(x[0] for x in same) == before[:3]:
        for k, value in zip(leads, before[3:]):
            k[lead == 0] = value
    later = keys[0] != leads[0]  # rows are sorted, so what differs comes later
    if rule.own:
        later |= (keys[1] != leads[1]) | (keys[2] != leads[2])
    return later


def _classified(rule: Rule) -> Callable:
    """Of sorted segments: those to remove, and those whose anchor has several contents.

    Goes through the rows in order and remembers only the group it is in, the
    rows of one anchor and salt. Segments with a salt have an anchor with several.
    """
    names = _names(rule, KINDS)

    def segments_of(rows: dict[str, np.ndarray], where: np.ndarray) -> Iterator[pa.RecordBatch]:
        where = where & (rows["kind"] != SEVERAL)
        if where.any():
            yield _batch({c: x[where] for c, x in rows.items()}, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead: tuple | None = None  # the first segment equal to the last row
        several = False  # whether the last row's group has had two contents
        waiting: dict[str, np.ndarray] | None = None  # its first content, while that is the only one
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            settled = (rows["kind"] == REMOVED) | (rows["kind"] == COPY)
            done = {c: x[settled] for c, x in rows.items()}
            rows = {c: x[~settled] for c, x in rows.items()}
            if len(done["h1"]):
                yield _batch(done, names)
            size = len(rows["h1"])
            if not size:
                continue
            later = _repeats(rule, rows, lead)
            h1, salt, h2 = rows["h1"], rows["salt"], rows["h2"]
            gone = dict(rows, kind=np.where(later & (rows["kind"] == SEGMENT), REMOVED, rows["kind"]))
            yield from segments_of(gone, later)
            # Groups of this batch; the first may have begun in an earlier one.
            same = (h1[1:] == h1[:-1]) & (salt[1:] == salt[:-1])
            group = np.cumsum(np.concatenate([[0], ~same]))
            changes = np.concatenate([[0], same & (h2[1:] != h2[:-1])])
            goes_on = lead is not None and lead[:2] == (h1[0], salt[0])
            if goes_on:
                changes[0] = lead[2] != h2[0]
            many = np.bincount(group, weights=changes + (salt != 0), minlength=group[-1] + 1) > 0
            if goes_on:
                if many[0] and waiting is not None:
                    yield from segments_of(waiting, np.ones(len(waiting["h1"]), dtype=bool))
                many[0] |= several
            if not goes_on or many[0]:
                waiting = None
            yield from segments_of(rows, ~later & many[group])
            several = bool(many[-1])
            if several:
                waiting = None
            else:
                rest = ~later & (group == group[-1])
                rest = {c: x[rest] for c, x in rows.items()}
                if waiting is not None and group[-1] == 0:  # the same group, still with one content
                    rest = {c: np.concatenate([waiting[c], x]) for c, x in rest.items()}
                waiting = rest
            last = (h1[-1], salt[-1], h2[-1])
            begin = np.flatnonzero((h1 == last[0]) & (salt == last[1]) & (h2 == last[2]))[0]
            if not (lead is not None and lead[:3] == last and begin == 0):
                lead = (*last, *(rows[c][begin] for c in ("_id", "_h", "start")))

    return run


def by_document(docs: DataFrame) -> DataFrame:
    """The texts dealt by (_id, _h). Every use has the same columns, so one exchange serves all."""
    return identified(docs).repartition("_id", "_h")


def found_segments(keyed: DataFrame, rule: Rule) -> DataFrame:
    """What to remove and what to compare, stored in the shared folder."""
    rows = keyed.select("text", "_id", "_h").mapInArrow(_anchored(rule), _schema(rule, KINDS))
    rows = rows.repartition("h1", "salt")
    rows = rows.sortWithinPartitions("h1", "salt", "h2", "_id", "_h", "start")
    path = new_path(keyed.sparkSession, "segments")
    sorted_out = rows.mapInArrow(_classified(rule), _schema(rule, KINDS)).drop("salt")
    sorted_out.write.option("compression", "zstd").parquet(path)
    return keyed.sparkSession.read.parquet(path)


def with_passages(texts: DataFrame, segments_: DataFrame, rule: Rule) -> DataFrame:
    """(h1, group, _id, _h, start, off, n, passage): the segments with their content.

    ``passage`` is the bytes, or the words joined by one space. ``segments_`` has
    a column ``group`` besides those of PLACES.
    """
    lists = segments_.groupBy("_id", "_h").agg(
        F.collect_list(F.struct("start", "off", "n", "h1", "group")).alias("places")
    )
    # Rows that repeat id and text give equal passages, of which none is earlier.
    rows = texts.join(lists, ["_id", "_h"]).select("doc_id", "text", "_id", "_h", "places")
    schema = "h1 bigint, group bigint, _id bigint, _h bigint, start int, off int, n int, passage binary"
    return rows.mapInArrow(_cut(rule), schema)


def _cut(rule: Rule) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches):
            places = part.column("places")
            flat = places.flatten()
            counts = np.diff(places.offsets.to_numpy())
            row = np.repeat(np.arange(part.num_rows), counts)
            start, off, n, h1, group = (flat.field(i).to_numpy() for i in range(5))
            raw = data.tobytes()
            if rule.unit == "byte":
                low = offsets[row] + start
                high = low + n - 1 + rule.window
                passages = [raw[a:b] for a, b in zip(low.tolist(), high.tolist())]
            else:
                starts, ends, first = words_of(data, offsets)
                low = first[row] + start
                high = low + n - 1 + rule.window
                passages = [
                    b" ".join([raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())])
                    for a, b in zip(low.tolist(), high.tolist())
                ]
            ids, texts = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("_id", "_h"))
            yield pa.record_batch(
                [
                    *(pa.array(x, pa.int64()) for x in (h1, group, ids, texts)),
                    *(pa.array(x, pa.int32()) for x in (start, off, n)),
                    pa.array(passages, pa.binary()),
                ],
                names=["h1", "group", "_id", "_h", "start", "off", "n", "passage"],
            )

    return run


def _windows(rule: Rule) -> Callable:
    """Two hashes of each window of each passage, for anchors with very many contents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in blocks(batches, "passage"):
            codes, first, _, _ = symbols_of(rule, data, offsets)
            n = part.column("n").to_numpy()
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = first[row] + step
            one, two = Hashes(codes), Hashes(mixed(codes))
            columns = [x.of(at, at + rule.window).view(np.int64) for x in (one, two)]
            columns += [
                part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("_id", "_h")
            ]
            yield pa.record_batch(
                [
                    *(pa.array(x, pa.int64()) for x in columns),
                    pa.array((part.column("start").to_numpy()[row] + step).astype(np.int32)),
                ],
                names=["w1", "w2", "_id", "_h", "start"],
            )

    return run


SPANS = "_id bigint, _h bigint, start int, end int"


def spans_by_window(passages: DataFrame, rule: Rule) -> DataFrame:
    """(_id, _h, start, end) of windows that occur earlier, each by itself: no group is gathered."""
    rows = passages.mapInArrow(
        _windows(rule), "w1 bigint, w2 bigint, _id bigint, _h bigint, start int"
    )
    key = ["_id", "_h", "start"] if rule.own else ["_id"]
    first = rows.groupBy("w1", "w2").agg(F.min(F.struct(*key)).alias("first"))
    later = rows.join(first, ["w1", "w2"]).where(F.struct(*key) > F.col("first"))
    return later.select("_id", "_h", "start", (F.col("start") + rule.window).alias("end"))


def removed_spans(
    texts: DataFrame,
    found: DataFrame,
    rule: Rule,
    grouped: Callable[[DataFrame], DataFrame],
    resolve: Callable[[DataFrame], DataFrame],
    large: int = LARGE_GROUP,
) -> DataFrame:
    """(_id, _h, spans): what to remove from each document, in symbols, unmerged.

    ``grouped`` gives segments a ``group``, ``resolve`` compares passages by group.
    """
    removed = found.where(F.col("kind") == REMOVED).select(
        "_id", "_h", "start", (F.col("start") + F.col("n") - 1 + rule.window).alias("end")
    )
    open_ones = found.where(F.col("kind") == SEGMENT).drop("kind")
    most = open_ones.groupBy("h1").agg(F.count("*").alias("m")).where(F.col("m") > large)
    spans = removed
    if not most.isEmpty():
        most = most.select("h1")
        ones = open_ones.join(most, "h1", "left_semi").withColumn("group", F.lit(0).cast("bigint"))
        spans = spans.unionByName(spans_by_window(with_passages(texts, ones, rule), rule))
        open_ones = open_ones.join(most, "h1", "left_anti")
    spans = spans.unionByName(resolve(with_passages(texts, grouped(open_ones), rule)))
    if rule.own:  # repeats in a document are removed, so there are no copies
        return spans.groupBy("_id", "_h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    copies = found.where(F.col("kind") == COPY).select(
        "_id", "_h", "start", (F.col("start") + F.col("n")).alias("end"), F.col("off").alias("lead")
    )
    places = spans.withColumn("lead", F.lit(-1)).unionByName(copies).groupBy("_id", "_h")
    places = places.agg(
        F.collect_list(F.struct("start", "end", "lead")).alias("places"), F.min("lead").alias("least")
    )
    places = places.where("least < 0").select("_id", "_h", "places")
    return places.mapInArrow(_copied(rule), f"_id bigint, _h bigint, spans {SPAN_LIST}")


SPAN_LIST = "array<struct<start: int, end: int>>"


def _copied(rule: Rule) -> Callable:
    """The spans of each document with those that copies take over from the segment they repeat.

    Each window start belongs to one segment. So of the window starts that the
    spans remove, a copy takes over those of its segment, moved to its own place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places")
            flat = places.flatten()
            start, end, lead = (flat.field(i).to_numpy().astype(np.int64) for i in range(3))
            stops = np.cumsum(np.diff(places.offsets.to_numpy()))
            sizes, starts, ends = [0], [], []
            for a, b in zip([0, *stops[:-1].tolist()], stops.tolist()):
                own = lead[a:b] < 0
                low, high = start[a:b][own], end[a:b][own]
                if not own.all():
                    low, high = _taken_over(
                        low, high - rule.window + 1, start[a:b][~own], end[a:b][~own], lead[a:b][~own]
                    )
                    high = high + rule.window - 1
                starts.append(low)
                ends.append(high)
                sizes.append(len(low))
            both = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, ends)]
            both = [pa.array(x.astype(np.int32)) for x in both]
            spans = pa.ListArray.from_arrays(
                pa.array(np.cumsum(sizes).astype(np.int32)),
                pa.StructArray.from_arrays(both, names=["start", "end"]),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_h"), spans], names=["_id", "_h", "spans"]
            )

    return run


def _taken_over(
    low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray, lead: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of removed window starts: those from low to high, and the copies' from start to end."""
    size = int(max(high.max(), end.max()))
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, low, 1)
    np.add.at(edge, high, -1)
    gone = np.cumsum(edge)[:-1] > 0
    for a, b, first in zip(start.tolist(), end.tolist(), lead.tolist()):
        gone[a:b] |= gone[first : first + b - a]
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def merged_runs(spans: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs that each row's spans cover, sorted."""
    if spans.null_count:
        spans = pa.array(spans.to_pylist(), spans.type) if spans.offset else spans
    counts = np.diff(spans.offsets.to_numpy())
    row = np.repeat(np.arange(len(spans)), counts)
    start, end = (spans.flatten().field(i).to_numpy().astype(np.int64) for i in (0, 1))
    if not len(row):
        return row, start, end
    order = np.lexsort((end, start, row))
    row, start, end = row[order], start[order], end[order]
    # Rows are kept apart by adding more than any end for each row before.
    apart = row * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + apart)
    new = np.concatenate([[True], (start + apart)[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(row) - 1]])
    return row[new], start[new], (reach - apart)[last]
