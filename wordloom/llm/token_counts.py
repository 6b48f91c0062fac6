"""Token counts of texts by a sentencepiece or tokenizers vocabulary.

A text falls apart into pre-tokens over whose ends no token reaches, so the
count of a text is the sum over its pre-tokens. Lengths of pre-tokens come from
two tiers: a broadcast table of frequent ones, then a cache in each task that
encodes what it has not met. No pre-token is shuffled. The table is made from a
bounded draw of texts; which pre-tokens it holds decides what is encoded again in
each task, and no count.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_TOKENS = 32_768  # entries of the broadcast table
DRAWN_TEXTS, DRAWN_BYTES = 4_000, 8_192  # texts the table is made from, and bytes of each, at most
CACHE_TOKENS = 400_000  # of a task's cache; a full cache starts anew
LONGEST_KEY = 64  # longer pre-tokens are encoded each time, so tables are bounded in bytes
OVER_LIMIT = 4_096

# Fixed value: the mark for a space in the pieces.
MARK = "▁"

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


class PieceLengths:
    """Token counts by a sentencepiece model of type BPE that keeps its input as it is.

    Pieces hold the mark only in front, so a cut before each run of marks is
    never crossed; nor is a line end, which no piece holds.
    """

    parts = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        normal = [p for i, p in enumerate(pieces) if not self.model.is_byte(i)]
        same = f"{MARK} aﬁ b  ".replace(" ", MARK)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in normal) or (
            self.model.normalize(" aﬁ b  ") != same
        ):
            raise ValueError("the pieces of this model reach over white space")
        # What the model gives for a line end in front of the part to be counted.
        self.front = len(self.model.encode("\n"))

    def split(self, text: str) -> list[str]:
        return self.parts.findall(MARK + text.replace(" ", MARK)) if text else []

    def lengths(self, parts: list[str]) -> list[int]:
        encoded = self.model.encode(["\n" + p for p in parts], num_threads=1)
        return [len(ids) - self.front for ids in encoded]


class JsonLengths:
    """Token counts by a tokenizers file.

    The file's own normalizer and splitter give the pre-tokens, which its model counts one by
    one. A text that holds an added token, or all texts of a file without a
    splitter, are one part and go through the whole tokenizer.
    """

    whole = "\x00whole:"  # in front of such a text

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model.decode())
        self.model.no_truncation()
        self.model.no_padding()
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)), re.I) if added else None

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        splitter, normalizer = self.model.pre_tokenizer, self.model.normalizer
        if splitter is None or self.added and self.added.search(text):
            return [self.whole + text]
        if normalizer is not None:
            text = normalizer.normalize_str(text)
        return [part for part, _ in splitter.pre_tokenize_str(text)]

    def lengths(self, parts: list[str]) -> list[int]:
        out = []
        for is_whole, some in groupby(parts, lambda p: p.startswith(self.whole)):
            if is_whole:
                texts = [p[len(self.whole) :] for p in some]
                out += [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]
            else:
                out += [len(self.model.model.tokenize(p)) for p in some]
        return out


def lengths_of(kind: str, model: bytes) -> PieceLengths | JsonLengths:
    return PieceLengths(model) if kind == "model" else JsonLengths(model)


def count_tokens(
    docs: DataFrame, vocabulary: str, over: int = OVER_LIMIT, table_tokens: int = TABLE_TOKENS
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``vocabulary`` is the path of a .model or .json file on the driver; its
    bytes, under 2 MB in public vocabularies, are broadcast. Null and empty
    texts have no bytes and no tokens. Ids may be null or repeated; each row
    stands for itself. Other columns are not read.
    """
    with open(vocabulary, "rb") as file:
        model = file.read()
    kind = vocabulary.rpartition(".")[2]
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((kind, model, _frequent(docs, kind, model, table_tokens)))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    counted = rows.mapInArrow(_counter(shared), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > over)


def _frequent(docs: DataFrame, kind: str, model: bytes, most: int) -> dict[str, int]:
    """The lengths of at most ``most`` frequent pre-tokens of a draw of texts.

    Whole texts of at most DRAWN_BYTES, drawn by a hash of the row, come to the driver.
    """
    if not most:
        return {}
    rate = max(1, docs.count() // DRAWN_TEXTS)
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rate)) == 0)
    drawn = drawn.where(F.octet_length("text") <= DRAWN_BYTES).select("text").limit(DRAWN_TEXTS)
    lengths = lengths_of(kind, model)
    seen = Counter(chain.from_iterable(lengths.split(row["text"]) for row in drawn.collect()))
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))
    parts = [part for part, _ in top if len(part) <= LONGEST_KEY][:most]
    return dict(zip(parts, lengths.lengths(parts)))


def _counter(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, model, table = shared.value
        lengths = lengths_of(kind, model)
        known = dict(table)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            counts = []
            for at in range(0, len(texts), 256):
                split = [lengths.split(text) for text in texts[at : at + 256]]
                new = list(set(chain.from_iterable(split)).difference(known))
                long = {}
                for first in range(0, len(new), 4096):
                    some = new[first : first + 4096]
                    for part, n in zip(some, lengths.lengths(some)):
                        (known if len(part) <= LONGEST_KEY else long)[part] = n
                find = {**known, **long}.__getitem__ if long else known.__getitem__
                counts += [sum(map(find, parts)) for parts in split]
                if len(known) > CACHE_TOKENS:
                    known = dict(table)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run
