"""Katz backoff bigram model over all documents, and the scores of their texts.

Events (history, token) are dealt to buckets by a hash of the history, packed
into blobs per task and bucket. A bucket thus holds its part of the bigram table
and all that is to be scored with it. Histories so frequent that they would
outgrow a bucket are dealt to several by a hash of the token. What crosses
buckets is small: how often a token occurs, sent from its own bucket to those
that need it; counts of counts; and sums over the frequent histories.

    P(w | h) = d(r) r / c(h)      if r = c(h, w) > 0
             = alpha(h) P(w)      otherwise,  P(w) = (c(w) + 1/2) / (N + (V + 1) / 2)

d are the Good-Turing discounts of counts up to 5. alpha(h) is the mass that
seen tokens leave, over the mass P gives the tokens not seen, so that P(. | h)
sums to one over the V training tokens and one for all unknown.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.texts import LOWER, blocks, mixed, opened, shipped, word_hashes, words_of

FOLDS, HELD_OUT = 5, 1
DISCOUNTED = 5  # counts up to this are discounted
TASK_EVENTS = 2_000_000  # packed at once
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

DOCS, EVENTS = 0, 1
PACKED = "bucket int, kind int, source bigint, blob binary"
SENT = "bucket int, kind int, blob binary"
COUNTS, STATS, SUMS = 0, 1, 2


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; integers take as few bytes as they need."""
    held = {}
    for name, x in arrays.items():
        if x.dtype.kind in "iu" and x.dtype != np.uint64 and len(x) and x.min() >= 0:
            x = x.astype(np.min_scalar_type(x.max()))
        held[name] = x
    out = io.BytesIO()
    np.savez(out, **held)
    raw = out.getvalue()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    with np.load(io.BytesIO(raw)) as held:
        return {name: held[name] for name in held.files}


class Deal:
    """Which bucket an event goes to; ``hot`` histories have several."""

    def __init__(self, buckets: int, hot: dict[int, int]):
        self.buckets = buckets
        self.hot = np.array(sorted(hot), dtype=np.uint64)
        self.parts = np.array([hot[h] for h in sorted(hot)], dtype=np.uint64)

    def is_hot(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(words), dtype=bool)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return self.hot[at] == words

    def bucket(self, history: np.ndarray, token: np.ndarray) -> np.ndarray:
        key = history.copy()
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, history), len(self.hot) - 1)
            part = mixed(token) % self.parts[at] + np.uint64(1)
            key = np.where(self.hot[at] == history, mixed(key + part * np.uint64(0x9E3779B9)), key)
        return (mixed(key ^ np.uint64(0x51ED270B)) % np.uint64(self.buckets)).astype(np.int64)


def _frequent(buckets: int) -> Callable:
    """Histories of a task that take more than a quarter of a bucket's share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for _, data, offsets in blocks(batches):
            data = LOWER[data]
            starts, ends, _ = words_of(data, offsets)
            hashes = np.concatenate([words, word_hashes(data, starts, ends)])
            weight = np.concatenate([counts, np.ones(len(starts), np.int64)])
            total += len(starts)
            words, at = np.unique(hashes, return_inverse=True)
            counts = np.bincount(at, weights=weight, minlength=len(words)).astype(np.int64)
            # Words that so far have far less than the share may start anew.
            keep = counts >= total / (64 * buckets)
            words, counts = words[keep], counts[keep]
        many = counts >= max(1, total / (4 * buckets))
        yield pa.record_batch(
            [
                pa.array(np.append(words[many].view(np.int64), 0)),
                pa.array(np.append(counts[many], 0)),
                pa.array(np.append(np.zeros(int(many.sum()), np.int64), total)),
            ],
            names=["word", "n", "total"],
        )

    return run


def _deal(rows: DataFrame, buckets: int) -> Deal:
    """The frequent histories: at most a few for each bucket come to the driver."""
    found = rows.select("text").mapInArrow(_frequent(buckets), "word bigint, n bigint, total bigint")
    found = found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).cache()
    total = found.agg(F.sum("total")).first()[0] or 0
    share = max(1, total // (2 * buckets))
    hot = found.where((F.col("n") >= share) & (F.col("n") > 0)).collect()
    found.unpersist()
    parts = {np.uint64(r["word"] % 2**64): 1 + r["n"] // share for r in hot}
    parts[START] = 1 + rows.count() // share
    return Deal(buckets, {int(h): n for h, n in parts.items()})


def _packer(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = opened(shared)
        source = TaskContext.get().partitionId() << 24
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, source
            history, token, doc, train = (np.concatenate(x) for x in zip(*(h[0] for h in held)))
            columns = zip(*(h[1] for h in held))
            ids, null, n_tokens, doc_train = (np.concatenate(x) for x in columns)
            rows = [(source % deal.buckets, DOCS, pack(
                ids=ids, null=null, n_tokens=n_tokens, train=doc_train))]
            bucket = deal.bucket(history, token)
            order = np.lexsort((doc, ~train, token, history, bucket))
            history, token, doc, train, bucket = (
                x[order] for x in (history, token, doc, train, bucket)
            )
            needs = _needs(deal, token, bucket)
            edges = np.searchsorted(bucket, np.arange(deal.buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                part = slice(edges[b], edges[b + 1])
                rows.append((int(b), EVENTS, _pack_events(
                    history[part], token[part], doc[part], train[part], needs)))
            for first in range(0, len(rows), 64):
                some = rows[first : first + 64]
                yield pa.record_batch(
                    [
                        pa.array([r[0] for r in some], pa.int32()),
                        pa.array([r[1] for r in some], pa.int32()),
                        pa.array([source] * len(some), pa.int64()),
                        pa.array([r[2] for r in some], pa.binary()),
                    ],
                    names=["bucket", "kind", "source", "blob"],
                )
            held, size = [], 0
            source += 1

        n_docs = 0
        for part, data, offsets in blocks(batches):
            data = LOWER[data]
            starts, ends, first = words_of(data, offsets)
            hashes = word_hashes(data, starts, ends)
            n = part.num_rows
            # Each text's words with START in front and END behind, end to end.
            at = np.arange(len(hashes)) + 2 * np.repeat(np.arange(n), np.diff(first)) + 1
            line = np.full(len(hashes) + 2 * n, END, dtype=np.uint64)
            line[at] = hashes
            line[first[:-1] + 2 * np.arange(n)] = START
            doc = np.repeat(np.arange(n), np.diff(first) + 2)
            inside = np.flatnonzero(doc[1:] == doc[:-1])
            train = part.column("fold").to_numpy() != HELD_OUT
            if not size:
                n_docs = 0
            own = doc[inside]
            held.append((
                (line[inside], line[inside + 1], own + n_docs, train[own]),
                (
                    part.column("doc_id").fill_null(0).to_numpy(),
                    part.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                    np.diff(first) + 1,
                    train.astype(np.int64),
                ),
            ))
            n_docs += n
            size += len(inside)
            if size >= TASK_EVENTS:
                yield from flush()
        if held:
            yield from flush()

    return run


def _needs(deal: Deal, token: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) sorted: which buckets need to know how often a word occurs."""
    pair = np.unique(mixed(token) ^ mixed(bucket.astype(np.uint64)), return_index=True)[1]
    word, where = token[pair], bucket[pair]
    other = ~deal.is_hot(word) & (word != END)
    word, where = word[other], where[other]
    order = np.lexsort((where, word))
    return word[order], where[order]


def _pack_events(history, token, doc, train, needs) -> bytes:
    new = np.ones(len(history), dtype=bool)
    new[1:] = (history[1:] != history[:-1]) | (token[1:] != token[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(history)))
    trained = np.add.reduceat(train.astype(np.int64), first)
    histories, entries = np.unique(history[first], return_counts=True)
    tokens, which = np.unique(token[first], return_inverse=True)
    low = np.searchsorted(needs[0], histories)
    n_needs = np.searchsorted(needs[0], histories, side="right") - low
    at = np.repeat(low - (np.cumsum(n_needs) - n_needs), n_needs) + np.arange(n_needs.sum())
    return pack(
        histories=histories, entries=entries, tokens=tokens, which=which, trained=trained,
        counts=counts, docs=doc, n_needs=n_needs, needs=needs[1][at],
    )


class Bucket:
    """The bigrams of a bucket: entries of all sources, and what they add up to."""

    def __init__(self, rows: pa.Table):
        self.sources, blobs = [], []
        for kind, source, blob in zip(*(rows.column(c).to_pylist() for c in ("kind", "source", "blob"))):
            if kind == EVENTS:
                self.sources.append(source)
                blobs.append(unpack(blob))
        self.blobs = blobs
        join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)])
        history = join([np.repeat(b["histories"], b["entries"]) for b in blobs], np.uint64)
        token = join([b["tokens"][b["which"]] for b in blobs], np.uint64)
        self.trained = join([b["trained"] for b in blobs], np.int64).astype(np.int64)
        self.counts = join([b["counts"] for b in blobs], np.int64).astype(np.int64)
        order = np.lexsort((token, history))
        h, w = history[order], token[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        self.pair = np.empty(len(h), np.int64)  # of each entry
        self.pair[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.history, self.token = h[first], w[first]
        self.r = np.bincount(self.pair, weights=self.trained, minlength=len(first)).astype(np.int64)
        self.histories, at = np.unique(self.history, return_inverse=True)
        self.of = at  # the history of each pair
        n = len(self.histories)
        total = lambda x: np.bincount(at, weights=x, minlength=n)
        self.c = total(self.r)
        self.by_count = np.stack([total(self.r == r) for r in range(1, DISCOUNTED + 1)], axis=1)


def _stats(shared) -> Callable:
    """Counts of counts of a bucket, and the counts of its part of frequent histories."""

    def run(rows: pa.Table) -> pa.Table:
        deal, b = opened(shared), Bucket(rows)
        hot = deal.is_hot(b.histories)
        sizes = np.array([(b.r == r).sum() for r in range(1, DISCOUNTED + 2)], np.int64)
        blob = pack(
            sizes=sizes, n=np.array([b.r.sum()]), v=np.array([(b.c[~hot] > 0).sum()]),
            hot=b.histories[hot], c=b.c[hot], by_count=b.by_count[hot].ravel(),
        )
        return pa.table({"blob": pa.array([blob], pa.binary())})

    return run


def _tell_counts(shared) -> Callable:
    """How often each word of a bucket occurs in training, for each bucket that needs it."""

    def run(rows: pa.Table) -> pa.Table:
        deal, b = opened(shared), Bucket(rows)
        word, where = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for blob in b.blobs:
            word.append(np.repeat(blob["histories"], blob["n_needs"]))
            where.append(blob["needs"].astype(np.int64))
        word, where = np.concatenate(word), np.concatenate(where)
        place = np.searchsorted(b.histories, word)
        key = np.unique(where * len(b.histories) + place)
        where, place = key // max(1, len(b.histories)), key % max(1, len(b.histories))
        known = b.c[place] > 0
        where, place = where[known], place[known]
        edges = np.searchsorted(where, np.arange(deal.buckets + 1))
        out = []
        for to in np.flatnonzero(np.diff(edges)):
            at = place[edges[to] : edges[to + 1]]
            out.append((int(to), pack(words=b.histories[at], counts=b.c[at].astype(np.int64))))
        return pa.table(
            {
                "bucket": pa.array([x[0] for x in out], pa.int32()),
                "kind": pa.array([COUNTS] * len(out), pa.int32()),
                "blob": pa.array([x[1] for x in out], pa.binary()),
            }
        )

    return run


def discounts(sizes: np.ndarray) -> np.ndarray:
    """d(1) to d(DISCOUNTED) from the numbers of bigrams seen 1, 2, ... times.

    Where Good-Turing gives no value between 0 and 1, as in small corpora, half
    an occurrence is taken off.
    """
    out = np.empty(DISCOUNTED)
    first = sizes[0]
    cut = (DISCOUNTED + 1) * sizes[DISCOUNTED] / first if first else 1.0
    for r in range(1, DISCOUNTED + 1):
        d = -1.0
        if sizes[r - 1] and cut < 1:
            d = ((r + 1) * sizes[r] / sizes[r - 1] / r - cut) / (1 - cut)
        out[r - 1] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def _joined(blobs: list[bytes]) -> dict:
    """The statistics of all buckets together."""
    parts = [unpack(b) for b in blobs]
    hot = np.concatenate([*(p["hot"] for p in parts), np.zeros(0, np.uint64)])
    words, at = np.unique(hot, return_inverse=True)
    c = np.bincount(at, np.concatenate([*(p["c"] for p in parts), np.zeros(0)]), len(words))
    rows = np.concatenate([*(p["by_count"].reshape(-1, DISCOUNTED) for p in parts), np.zeros((0, DISCOUNTED))])
    by_count = np.stack([np.bincount(at, r, len(words)) for r in rows.T], axis=1)
    n = sum(int(p["n"][0]) for p in parts)
    trained = c[words == START].sum() if len(words) else 0  # texts, and so ENDs
    v = sum(int(p["v"][0]) for p in parts) + int((c[words != START] > 0).sum()) + int(trained > 0)
    sizes = np.sum([p["sizes"].astype(np.int64) for p in parts], axis=0) if parts else np.zeros(6)
    return {
        "d": discounts(sizes), "n": np.array([n]), "v": np.array([v]), "hot": words, "c": c,
        "by_count": by_count.ravel(), "ends": np.array([trained]),
    }


def _collected(kind: int) -> Callable:
    """One blob for all buckets, copied to each."""

    def run(rows: pa.Table) -> pa.Table:
        blobs = rows.column("blob").to_pylist()
        if kind == STATS:
            return pa.table({"blob": pa.array([pack(**_joined(blobs))], pa.binary())})
        parts = [unpack(b) for b in blobs]
        hot = np.concatenate([*(p["hot"] for p in parts), np.zeros(0, np.uint64)])
        mass = np.concatenate([*(p["mass"] for p in parts), np.zeros(0)])
        words, at = np.unique(hot, return_inverse=True)
        sums = np.bincount(at, mass, len(words))
        return pa.table({"blob": pa.array([pack(hot=words, mass=sums)], pa.binary())})

    return run


def _looked_up(keys: np.ndarray, values: np.ndarray, words: np.ndarray, default: float = 0.0):
    if not len(keys):
        return np.full(len(words), default)
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    return np.where(keys[at] == words, values[at], default)


def _probabilities(shared, rows: pa.Table, sent: pa.Table):
    """The bucket, c(w) of each pair, P(w), and the statistics."""
    deal, b = opened(shared), Bucket(rows)
    by_kind: dict[int, list] = {COUNTS: [], STATS: [], SUMS: []}
    for kind, blob in zip(sent.column("kind").to_pylist(), sent.column("blob").to_pylist()):
        by_kind[kind].append(unpack(blob))
    s = by_kind[STATS][0]
    words = np.concatenate([*(x["words"] for x in by_kind[COUNTS]), s["hot"]])
    counts = np.concatenate([*(x["counts"] for x in by_kind[COUNTS]), s["c"]]).astype(np.float64)
    order = np.argsort(words)
    c = _looked_up(words[order], counts[order], b.token)
    c[b.token == END] = s["ends"][0]
    n, v = float(s["n"][0]), float(s["v"][0])
    return deal, b, c, (c + 0.5) / (n + 0.5 * (v + 1)), s, by_kind[SUMS]


def _hot_mass(shared) -> Callable:
    """What P gives the tokens seen behind each frequent history, of this bucket."""

    def run(rows: pa.Table, sent: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.table({"blob": pa.array([], pa.binary())})
        deal, b, _, p, _, _ = _probabilities(shared, rows, sent)
        mass = np.bincount(b.of, weights=p * (b.r > 0), minlength=len(b.histories))
        hot = deal.is_hot(b.histories)
        return pa.table({"blob": pa.array([pack(hot=b.histories[hot], mass=mass[hot])], pa.binary())})

    return run


def _score(shared) -> Callable:
    """Sums over the events of a bucket for each document of each source."""

    def run(rows: pa.Table, sent: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            deal, b, c, p, s, sums = _probabilities(shared, rows, sent)
            mass = np.bincount(b.of, weights=p * (b.r > 0), minlength=len(b.histories))
            total, by_count = b.c.astype(np.float64), b.by_count.astype(np.float64)
            hot = deal.is_hot(b.histories)
            if hot.any():
                at = np.searchsorted(s["hot"], b.histories[hot])
                total[hot] = s["c"][at]
                by_count[hot] = s["by_count"].reshape(-1, DISCOUNTED)[at]
                mass[hot] = _looked_up(sums[0]["hot"], sums[0]["mass"], b.histories[hot])
            small = np.arange(1, DISCOUNTED + 1)
            left = (by_count * small * (1 - s["d"])).sum(axis=1)
            # A history of which no count is discounted gets one occurrence more in total.
            total = total + ((left <= 0) & (total > 0))
            left = np.where((left <= 0) & (total > 0), 1.0, left)
            alpha = np.where(total > 0, left / np.maximum(total, 1) / np.maximum(1 - mass, 1e-300), 1.0)
            d = np.concatenate([[0.0], s["d"], [1.0]])[np.minimum(b.r, DISCOUNTED + 1)]
            seen = d * b.r / np.maximum(total, 1)[b.of]
            log_p = np.log10(np.where(b.r > 0, seen, alpha[b.of] * p))
            log_base, known = np.log10(p), c > 0
            at = 0
            for source, blob in zip(b.sources, b.blobs):
                n = len(blob["which"])
                pair = np.repeat(b.pair[at : at + n], b.counts[at : at + n])
                docs, own = np.unique(blob["docs"], return_inverse=True)
                sum_ = lambda x: np.bincount(own, weights=x[pair], minlength=len(docs))
                out.append((source, pack(
                    docs=docs, score=sum_(log_p), base=sum_(log_base),
                    known=sum_(known).astype(np.int64), n=s["n"])))
                at += n
        return pa.table(
            {
                "source": pa.array([x[0] for x in out], pa.int64()),
                "blob": pa.array([x[1] for x in out], pa.binary()),
            }
        )

    return run


SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
    " base_score double, score double"
)


def _documents(docs: pa.Table, parts: pa.Table) -> pa.Table:
    """The documents of one source with their sums over all buckets."""
    d = unpack(docs.column("blob")[0].as_py())
    n = len(d["ids"])
    score, base, known, trained = np.zeros(n), np.zeros(n), np.zeros(n, np.int64), 0
    for blob in parts.column("blob").to_pylist():
        x = unpack(blob)
        score[x["docs"]] += x["score"]
        base[x["docs"]] += x["base"]
        known[x["docs"]] += x["known"]
        trained = int(x["n"][0])
    return pa.table(
        {
            "doc_id": pa.array(d["ids"].astype(np.int64), mask=d["null"].astype(bool)),
            "held_out": pa.array(d["train"] == 0),
            "n_tokens": pa.array(d["n_tokens"].astype(np.int64)),
            "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(n, trained)),
            "base_score": pa.array(base),
            "score": pa.array(score),
        }
    )


def backoff_scores(docs: DataFrame) -> DataFrame:
    """The columns of SCORES, one row per row of ``docs``.

    The model learns from rows whose crc32 of the id, as text, leaves another
    remainder than HELD_OUT by FOLDS; a null id counts as the text "null".
    Tokens are lower-case words and one end; null and empty texts are the end
    alone. Scores are log10 probabilities. Words are told apart by 64-bit
    hashes. Without any training row all counts are zero. Other columns are not
    read; each of repeated rows counts.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc_id = F.col("doc_id").cast("bigint")
    text_id = F.coalesce(doc_id.cast("string"), F.lit("null"))
    rows = docs.select(
        doc_id.alias("doc_id"),
        "text",
        (F.crc32(F.encode(text_id, "UTF-8")) % FOLDS).cast("bigint").alias("fold"),
    )
    shared = shipped(spark, _deal(rows, buckets))
    packed = rows.mapInArrow(_packer(shared), PACKED).repartition(buckets, "bucket")
    each = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))

    def to_all(blob: DataFrame, kind: int) -> DataFrame:
        """A copy of the one blob of all buckets for each of them."""
        one = blob.groupBy(F.lit(0).alias("one")).applyInArrow(_collected(kind), "blob binary")
        return each.crossJoin(F.broadcast(one)).select("bucket", F.lit(kind).alias("kind"), "blob")

    events = packed.groupBy("bucket")
    stats = to_all(events.applyInArrow(_stats(shared), "blob binary"), STATS)
    sent = events.applyInArrow(_tell_counts(shared), SENT).unionByName(stats)
    sent = sent.repartition(buckets, "bucket")
    mass = packed.groupBy("bucket").cogroup(sent.groupBy("bucket"))
    mass = to_all(mass.applyInArrow(_hot_mass(shared), "blob binary"), SUMS)
    sent = sent.unionByName(mass).repartition(buckets, "bucket")
    parts = packed.groupBy("bucket").cogroup(sent.groupBy("bucket"))
    parts = parts.applyInArrow(_score(shared), "source bigint, blob binary")
    sources = packed.where(F.col("kind") == DOCS).select("source", "blob")
    scored = sources.groupBy("source").cogroup(parts.groupBy("source"))
    return scored.applyInArrow(_documents, SCORES)
