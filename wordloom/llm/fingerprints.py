"""Fingerprints of documents: invertible Bloom lookup sketches of their paragraphs.

A sketch is a row of cells; each paragraph digest is hashed to three of them
and added there. Sketches of two versions subtract cell by cell, and what is
left peels: a cell with one digest gives it up, which frees others. That
recovers the digests in which the versions differ. Where peeling gets stuck,
both texts are sketched anew with four times the cells.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.neighbours import in_ranges, neighbours
from wordloom.llm.texts import identified, mixed

CELLS = 24  # of a fingerprint
GROWTH = 4
HASHES = 3
LONGEST = 256  # code points; a longer paragraph is cut from its start
TOGETHER = 256  # pairs of texts handled at once
LARGEST = 1 << 22  # cells handled at once
ENOUGH = 8  # cells for each digest of a pair, with which sketches peel
RANGE_BYTES = 64 * 1024 * 1024  # of texts in one range
NO_DIGESTS = np.zeros(0, np.uint64)

PARAGRAPHS = re.compile(r"(?<=[.!?])\s+|\n+")

SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_text string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)

Sketch = tuple[np.ndarray, np.ndarray, np.ndarray]


def digests(text: str) -> np.ndarray:
    """A 64-bit digest of each paragraph, sorted; repeats get other digests, by their number."""
    seen: dict[str, int] = {}
    out = []
    for line in PARAGRAPHS.split(text):
        for at in range(0, len(line), LONGEST):
            part = line[at : at + LONGEST]
            number = seen.get(part, 0)
            seen[part] = number + 1
            out.append(xxhash.xxh64_intdigest(part.encode(), seed=number))
    return np.unique(np.array(out, dtype=np.uint64))


def _check(keys: np.ndarray) -> np.ndarray:
    return mixed(keys + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)


def _places(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """For each hash, a cell in its own third of the sketch."""
    third = np.uint64(cells // HASHES)
    return [
        (mixed(keys ^ np.uint64((cells << 8) + i)) % third + np.uint64(i) * third).astype(np.int64)
        for i in range(HASHES)
    ]


def _xor_at(size: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(size, dtype=np.uint64)
    if len(at):
        order = np.argsort(at, kind="stable")
        at, values = at[order], values[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out[at[first]] = np.bitwise_xor.reduceat(values, first)
    return out


def sketches(groups: list[np.ndarray], cells: int) -> Sketch:
    """(counts, keys, checks), each with a row of cells per group of digests."""
    keys = np.concatenate(groups) if groups else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    size = len(groups) * cells
    at = np.concatenate([row * cells + p for p in _places(keys, cells)])
    counts = np.bincount(at, minlength=size).astype(np.int64)
    keys_at = _xor_at(size, at, np.tile(keys, HASHES))
    checks = _xor_at(size, at, np.tile(_check(keys), HASHES))
    return tuple(x.reshape(len(groups), cells) for x in (counts, keys_at, checks))


def subtract(a: Sketch, b: Sketch) -> Sketch:
    return a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]


def peel(difference: Sketch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(done, row, digest, side): which rows peeled to nothing, and the digests recovered.

    A digest of side 1 is only in the first of the two versions, one of side -1 only
    in the second. What a row that is not done has given up is true as well, but not all.
    """
    n, cells = difference[0].shape
    counts, keys, checks = (x.reshape(-1).copy() for x in difference)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    active = np.flatnonzero((counts == 1) | (counts == -1))
    while len(active):
        pure = active[
            ((counts[active] == 1) | (counts[active] == -1)) & (_check(keys[active]) == checks[active])
        ]
        if not len(pure):
            break
        row, key, sign = pure // cells, keys[pure], counts[pure]
        # A digest may be alone in several of its cells at once.
        order = np.lexsort((key, row))
        row, key, sign = row[order], key[order], sign[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
        row, key, sign = row[new], key[new], sign[new]
        found.append((row, key, sign))
        at = np.concatenate([row * cells + p for p in _places(key, cells)])
        np.subtract.at(counts, at, np.tile(sign, HASHES))
        np.bitwise_xor.at(keys, at, np.tile(key, HASHES))
        np.bitwise_xor.at(checks, at, np.tile(_check(key), HASHES))
        active = np.unique(at)
    stuck = (counts != 0) | (keys != 0) | (checks != 0)
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    row, key, side = (np.concatenate(x) for x in zip(none, *found))
    return ~stuck.reshape(n, cells).any(axis=1), row, key, side


def differences(
    a: list[np.ndarray], b: list[np.ndarray], first: tuple[Sketch, Sketch] | None = None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each pair of texts the digests only in the first, and those only in the second, sorted.

    ``first`` are the sketches of CELLS cells, where they are at hand. Pairs that do
    not peel get larger sketches; with ENOUGH cells for each digest and still stuck,
    which takes digests made for it, the lists themselves are compared.
    """
    only: tuple[list[np.ndarray], list[np.ndarray]] = ([NO_DIGESTS] * len(a), [NO_DIGESTS] * len(a))
    left, cells = np.arange(len(a)), CELLS
    while len(left):
        sizes = np.array([len(a[i]) + len(b[i]) for i in left])
        for i in left[(cells > CELLS) & (cells > ENOUGH * GROWTH * sizes)].tolist():
            only[0][i], only[1][i] = np.setdiff1d(a[i], b[i]), np.setdiff1d(b[i], a[i])
        left = left[(cells <= CELLS) | (cells <= ENOUGH * GROWTH * sizes)]
        stuck = []
        step = max(1, LARGEST // cells)
        for at in range(0, len(left), step):
            some = left[at : at + step]
            if first is not None and cells == CELLS:
                one, two = (tuple(x[some] for x in s) for s in first)
            else:
                one, two = (sketches([g[i] for i in some], cells) for g in (a, b))
            done, row, key, side = peel(subtract(one, two))
            order = np.lexsort((key, row))
            row, key, side = row[order], key[order], side[order]
            for lists, sign in zip(only, (1, -1)):
                ends = np.searchsorted(row[side == sign], np.arange(len(some) + 1))
                mine = key[side == sign]
                for k in np.flatnonzero(done & (np.diff(ends) > 0)).tolist():
                    lists[some[k]] = mine[ends[k] : ends[k + 1]]
            stuck.append(some[~done])
        left, cells = np.concatenate([np.zeros(0, np.int64), *stuck]), cells * GROWTH
    return only


def likeness(
    a: list[np.ndarray], b: list[np.ndarray], first: tuple[Sketch, Sketch] | None = None
) -> np.ndarray:
    """The share of common digests among all of both, from their ``differences``.

    Two texts without paragraphs are alike.
    """
    only_a, only_b = (np.array(list(map(len, x))) for x in differences(a, b, first))
    common = np.array(list(map(len, a))) - only_a
    union = common + only_a + only_b
    return common / np.maximum(union, 1) + (union == 0)


def written(sketch: Sketch) -> list[str]:
    """Each row of cells as base64 of little-endian counts, keys and checks."""
    counts, keys, checks = sketch
    return [
        base64.b64encode(
            c.astype("<i4").tobytes() + k.astype("<u8").tobytes() + x.astype("<u4").tobytes()
        ).decode()
        for c, k, x in zip(counts, keys, checks)
    ]


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in neighbours(batches, TOGETHER):
        own, changed, following, texts = [], [], [], []
        for _, row, after in rows:
            text, after_text = row["text"] or "", after["text"] or ""
            for at in (row, after):
                if "digests" not in at:
                    at["digests"] = digests(at["text"] or "")
            texts.append(edited(text, after_text))
            own.append(row["digests"])
            changed.append(digests(texts[-1]))
            following.append(after["digests"])
        a, b, c = (sketches(x, CELLS) for x in (own, changed, following))
        yield pa.record_batch(
            [
                pa.array([row["doc_id"] for _, row, _ in rows], pa.int64()),
                pa.array([len(row["text"] or "") for _, row, _ in rows], pa.int64()),
                pa.array(texts, pa.string()),
                pa.array(written(a), pa.string()),
                pa.array(written(b), pa.string()),
                pa.array(likeness(own, changed, (a, b)), pa.float64()),
                pa.array(likeness(own, following, (a, c)), pa.float64()),
            ],
            names=[f.split()[0] for f in SCHEMA.split(", ")],
        )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited forms, one row per row of ``docs``.

    The next document is the one with the next smaller id, after the least the
    greatest; rows that share an id follow each other by a hash of their text. A
    null id is the least. Null texts count as empty; two empty texts are alike.
    A single row is its own next. Other columns are not read.
    """
    rows = identified(docs).select("doc_id", "text", F.bitwise_not("_id").alias("_down"), "_h")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))).first()[0] or 0
    rows = in_ranges(rows, "_down", "_h", wrap=True, least=-(-size // RANGE_BYTES))
    return rows.mapInArrow(_fingerprint, SCHEMA)


def _changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            sides = [[digests(x or "") for x in part.column(c).to_pylist()] for c in ("old", "new")]
            lists = [
                pa.array([x.view(np.int64) for x in side], pa.list_(pa.int64()))
                for side in differences(*sides)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *lists], names=["doc_id", "removed", "added"]
            )


def paragraph_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(doc_id, removed, added): digests of the paragraphs in which two versions of a document differ.

    One row for each pair of a row of ``old`` and one of ``new`` that share a doc_id; ids
    must not repeat in both, and rows without an id have no other version. Null
    texts count as empty. Digests are those of ``digests``, as signed numbers.
    """
    sides = [
        x.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias(name))
        for x, name in ((old, "old"), (new, "new"))
    ]
    pairs = sides[0].join(sides[1], "doc_id").select("doc_id", "old", "new")
    return pairs.mapInArrow(_changed, "doc_id bigint, removed array<bigint>, added array<bigint>")
