"""Where the tokens of two vocabularies end together, and how often their ids do so.

Texts fall apart at white space that no token of either vocabulary reaches over, so a
task encodes and merges each distinct part once. The ends of the tokens of all new
parts of a block are merged by paths: diagonals at equal distances, found by binary search, cut
the merge into pieces of equal work, whatever the lengths of the parts. Each
piece emits the ends that both have; an end that a diagonal parts is found at the
seam, and groups that reach over seams close at the next common end.

Counts of linked ids are summed over the corpus. The frequent pairs come back as a
broadcast table of bounded size; only the rare ones are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import kept
from wordloom.llm.texts import opened, shipped
from wordloom.scratch import new_path

PIECE = 16_384  # token ends that a piece of the merge reads
BLOCK_BYTES = 1024 * 1024  # of texts that are encoded and merged at once
CACHE_PARTS, CACHE_BYTES = 300_000, 32 * 1024 * 1024  # that a task remembers; beyond, it starts anew
TABLE_PAIRS = 1 << 19  # id pairs of the broadcast table, at most
STEPS = 8  # counts are told apart by so many steps a doubling when the table is chosen

# The mark of a space in pieces, and bytes that stand for themselves in byte-level entries.
MARK = "▁"
PLAIN_BYTES = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]

# A part is blanks and line ends with all up to the next ones. Before them words end in either
# vocabulary, unless other white space or an odd character stands there.
PARTS = re.compile("[ \n]+[^ \n]*|[^ \n]+")
OTHER_SPACE = re.compile(
    "[\x00-\x09\x0b-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)

ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, pairs array<bigint>, times array<int>"
)
TOLD = "n_best bigint, count_sum bigint"


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: itself, or one from 256 on."""
    plain = [b for first, last in PLAIN_BYTES for b in range(first, last + 1)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Vocabularies:
    """Both encoders, and for each the bytes of every id."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        values, of = self.a.get_vocab(), byte_of()
        self.bytes_a = [b""] * (max(values.values()) + 1)
        for entry, i in values.items():
            known = all(c in of for c in entry)
            self.bytes_a[i] = bytes(of[c] for c in entry) if known else entry.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        form = json.loads(byte_level)
        first = form.get("pre_tokenizer") or {}
        words = first.get("type") == "ByteLevel" and first.get("use_regex", True)
        inside = any(MARK in x.lstrip(MARK) or "\n" in x for x in self._plain_pieces())
        same = f"{MARK} aﬁ b  ".replace(" ", MARK)
        self.falls_apart = bool(
            words and not form.get("normalizer") and not inside and self.b.normalize(" aﬁ b  ") == same
        )
        self.front = len(self.b.encode("\n"))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def _plain_pieces(self) -> list[str]:
        return [self.b.id_to_piece(i) for i in range(self.b.get_piece_size()) if not self.b.is_byte(i)]

    def parts(self, text: str) -> list[str]:
        """Space and text, cut before blanks and line ends where that is safe, else as one part."""
        spaced = " " + text
        if not self.falls_apart or OTHER_SPACE.search(spaced):
            return [spaced]
        return PARTS.findall(spaced)

    def encode(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """(ids, number of ids of each part) by both, and which parts both give back byte by byte."""
        first = [x.ids for x in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        if self.falls_apart:  # no piece reaches over the line end put in front
            second = [x[self.front :] for x in self.b.encode(["\n" + p for p in parts], num_threads=1)]
        else:
            second = self.b.encode([p[1:] for p in parts], num_threads=1)
        same, want = np.ones(len(parts), dtype=bool), list(map(str.encode, parts))
        joined = b"".join(want)
        sizes = np.array(list(map(len, want)))
        ids, counts = [], []
        for found, table, size in ((first, self.bytes_a, self.size_a), (second, self.bytes_b, self.size_b)):
            counts.append(np.array(list(map(len, found))))
            flat = list(chain.from_iterable(found))
            ids.append(np.array(flat, np.int64))
            ends = np.concatenate([[0], np.cumsum(size[ids[-1]])])[np.cumsum(counts[-1])]
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join(map(table.__getitem__, flat)) != joined:
                same &= [b"".join(map(table.__getitem__, x)) == w for x, w in zip(found, want)]
        return ids, counts, same


def cuts(a: np.ndarray, b: np.ndarray, piece: int) -> np.ndarray:
    """(k, 2) places in a and b where diagonals ``piece`` apart cross their merge.

    All diagonals are searched at once. Of equal values that of ``a`` comes first.
    """
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        going = low < high
        before = np.zeros(len(low), dtype=bool)
        before[going] = a[middle[going]] <= b[diagonal[going] - middle[going] - 1]
        low = np.where(before, middle + 1, low)
        high = np.where(going & ~before, middle, high)
    return np.stack([low, diagonal - low], axis=1)


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all values that two rising sequences share, in order."""
    at = cuts(a, b, piece)
    found_a, found_b = [], []
    for (i0, j0), (i1, j1) in zip(at[:-1].tolist(), at[1:].tolist()):
        if i0 and j0 < len(b) and a[i0 - 1] == b[j0]:  # the seam stands between two equal ends
            found_a.append([i0 - 1])
            found_b.append([j0])
        place = np.searchsorted(b[j0:j1], a[i0:i1])
        inside = np.flatnonzero(place < j1 - j0)
        inside = inside[b[j0 + place[inside]] == a[i0 + inside]]
        found_a.append(i0 + inside)
        found_b.append(j0 + place[inside])
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]).astype(np.int64) for x in (found_a, found_b))


class Aligned:
    """What is known of parts, by number: tokens and groups, groups as text, linked pairs."""

    def __init__(self, both: Vocabularies):
        self.both = both
        last = [[f"{i},".encode(), f"{i}|".encode()] for i in range(len(both.bytes_a))]
        self.offset = 2 * len(last)
        last += [[f"{i},".encode(), f"{i};".encode()] for i in range(len(both.bytes_b))]
        self.written = [x for pair in last for x in pair]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.size = 0  # bytes of the texts
        self.same = np.zeros(0, dtype=bool)  # whether both vocabularies give the part back
        self.counts = np.zeros((0, 3), np.int64)  # n_a, n_b, n_groups
        self.begins = np.zeros(0, np.int64)  # of a part's pairs, one for each group
        self.pairs = np.zeros(0, np.int64)

    def numbers(self, parts: list[str]) -> np.ndarray:
        """The number of each part; new ones are encoded and merged."""
        new = list(dict.fromkeys(p for p in parts if p not in self.number))
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (end == at or size + len(new[end]) <= BLOCK_BYTES):
                size += len(new[end])
                end += 1
            self._learn(new[at:end])
            at = end
        return np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))

    def _learn(self, parts: list[str]) -> None:
        (a, b), (n_a, n_b), same = self.both.encode(parts)
        if not same.all():  # such parts have no tokens
            a, b = a[np.repeat(same, n_a)], b[np.repeat(same, n_b)]
            n_a, n_b = n_a * same, n_b * same
        i, j = common_ends(np.cumsum(self.both.size_a[a]), np.cumsum(self.both.size_b[b]))
        # The end of a part is one of both, so groups of different parts stay apart.
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[i], closes_b[j] = 1, 1
        n_groups = np.diff(np.concatenate([[0], np.cumsum(closes_a)])[np.cumsum(n_a)], prepend=0)
        # Each token's place when groups are written one after another, those of A first.
        order = np.empty(len(a) + len(b), np.int64)
        behind_b = np.concatenate([[0], j + 1])[np.cumsum(closes_a) - closes_a]
        behind_a = (i + 1)[np.cumsum(closes_b) - closes_b]
        order[np.arange(len(a)) + behind_b] = 2 * a + closes_a
        order[np.arange(len(b)) + behind_a] = self.offset + 2 * b + closes_b
        words = list(map(self.written.__getitem__, order.tolist()))
        stops = np.cumsum(n_a + n_b).tolist()
        texts = [b"".join(words[x:y]) for x, y in zip([0, *stops], stops)]
        known = len(self.texts)
        self.number.update(zip(parts, range(known, known + len(parts))))
        self.texts += texts
        self.size += sum(map(len, texts))
        self.same = np.concatenate([self.same, same])
        self.counts = np.concatenate([self.counts, np.stack([n_a, n_b, n_groups], axis=1)])
        begins = len(self.pairs) + np.cumsum(n_groups) - n_groups
        self.begins = np.concatenate([self.begins, begins])
        self.pairs = np.concatenate([self.pairs, (a[i] << 32) | b[j]])


def _align(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Aligned(Vocabularies(*opened(shared)))
        for batch in batches:
            ids = batch.column(0)
            texts = [text or "" for text in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
                    size += len(texts[end])
                    end += 1
                yield _block(known, texts[at:end], ids.slice(at, end - at))
                at = end

    return run


def _block(known: Aligned, texts: list[str], doc_ids: pa.Array) -> pa.RecordBatch:
    split = [known.both.parts(text) if text else [] for text in texts]
    at = known.numbers(list(chain.from_iterable(split)))
    n_parts = np.array(list(map(len, split)))
    row = np.repeat(np.arange(len(texts)), n_parts)
    broken = np.bincount(row, ~known.same[at], len(texts)) > 0
    at, row = at[~broken[row]], row[~broken[row]]
    n_parts = n_parts * ~broken
    rows = np.stack([np.bincount(row, known.counts[at, k], len(texts)) for k in range(3)]).astype(np.int64)
    digests, stop = [], np.cumsum(n_parts).tolist()
    listed = at.tolist()
    for first, last in zip([0, *stop], stop):
        said = b"".join([known.texts[k] for k in listed[first:last]])
        digests.append(hashlib.sha256(said[:-1]).hexdigest() if said else "")

    n = known.counts[at, 2]
    place = np.arange(n.sum()) + np.repeat(known.begins[at] - (np.cumsum(n) - n), n)
    pair, doc = known.pairs[place], np.repeat(row, n)
    by = np.lexsort((pair, doc))
    doc, pair = doc[by], pair[by]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(pair)))
    sizes = np.bincount(doc[first], minlength=len(texts))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    if len(known.texts) > CACHE_PARTS or known.size > CACHE_BYTES:
        known.forget()
    columns = [doc_ids, *(pa.array(rows[k], pa.int64()) for k in (0, 1, 2, 2))]
    columns += [pa.array(digests, pa.string())]
    columns += [
        pa.ListArray.from_arrays(offsets, pa.array(pair[first], pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])


def _frequent(counts: DataFrame, most: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(least count, pairs, counts, best): all pairs from a count on, at most ``most`` of them."""
    step = F.floor(F.log2(F.col("n")) * STEPS)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("k"), F.min("n").alias("n"))
    least, room = 2**62, most
    for _, k, n in sorted(map(tuple, sizes.collect()), reverse=True):
        room -= k
        if room < 0:
            break
        least = n
    table = counts.where(F.col("n") >= least).select("pair", "n", "best").toArrow()
    pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return least, pair[order], n[order], best[order]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of lists, and the row of each."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), lengths)


def _known(shared) -> Callable:
    """Per text the links whose count is in the table: how many are best, and the sum of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n, best = shared.value
        for batch in batches:
            pairs, row = _flat(batch.column("pairs"))
            times, _ = _flat(batch.column("times"))
            at = np.searchsorted(table, pairs)
            has = at < len(table)
            has[has] = table[at[has]] == pairs[has]
            at, row, times = at[has], row[has], times[has].astype(np.int64)
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * best[at])
            np.add.at(sums[1], row, times * n[at])
            names = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), *map(pa.array, sums)], names=[*names, "n_best", "count_sum"]
            )

    return run


def _rare(shared) -> Callable:
    """(row, pair, times) of the links whose count is not in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, _, _ = shared.value
        for batch in batches:
            pairs, row = _flat(batch.column("pairs"))
            times, _ = _flat(batch.column("times"))
            at = np.searchsorted(table, pairs)
            lacks = at >= len(table)
            lacks[~lacks] = table[at[~lacks]] != pairs[~lacks]
            rows = batch.column("row").to_numpy()[row[lacks]]
            columns = [pa.array(rows), pa.array(pairs[lacks]), pa.array(times[lacks], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "pair", "times"])

    return run


def align_tokens(
    docs: DataFrame, byte_level: str, pieces: str, table_pairs: int = TABLE_PAIRS
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row of ``docs``.

    ``byte_level`` is the path of a byte-level .json vocabulary (A), which gets a space and the
    text, ``pieces`` that of a .model one (B), which adds the space itself; both are read on the
    driver and broadcast. Tokens of A and B are linked if they end at the same byte, and
    the texts between such ends are groups. ``n_best`` counts the links whose id pair
    is, over all documents, linked most often among those with its B id, ties
    included; ``count_sum`` sums the counts of the pairs over the links. Texts that
    are null or empty, or that one of the vocabularies does not give back byte by
    byte, have no tokens: zeros and an empty string. Rows that repeat an id, or
    have none, stand for themselves. Texts with other white space than blanks and line ends are
    encoded as a whole. Other columns are not read.
    """
    spark = docs.sparkSession
    model = [open(path, "rb").read() for path in (byte_level, pieces)]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    aligned = rows.mapInArrow(_align(shipped(spark, tuple(model))), ALIGNED)
    path = new_path(spark, "aligned")
    aligned.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    aligned = spark.read.parquet(path)

    linked = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = linked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    counts = kept(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of B, so bounded
    counts = kept(
        counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )
    least, *table = _frequent(counts, table_pairs)
    shared = spark.sparkContext.broadcast(tuple(table))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]
    kinds = ALIGNED.split(", pairs")[0] + ", row bigint, " + TOLD
    known = aligned.select(*names, "pairs", "times").mapInArrow(_known(shared), kinds)
    rest = counts.where(F.col("n") < least)
    if not rest.isEmpty():
        rare = aligned.select("row", "pairs", "times").mapInArrow(
            _rare(shared), "row bigint, pair bigint, times int"
        )
        rare = rare.join(rest, "pair").groupBy("row").agg(
            F.sum(F.col("times") * F.col("best").cast("int")).alias("best_more"),
            F.sum(F.col("times") * F.col("n")).alias("sum_more"),
        )
        more = lambda c: F.coalesce(c, F.lit(0))
        known = known.join(rare, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + more("best_more"),
                "count_sum": F.col("count_sum") + more("sum_more"),
            }
        )
    return known.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
