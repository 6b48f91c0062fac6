"""Quality and toxicity of documents by co-training.

Two views of a document vote: its text, as shape statistics and telling words or
word ends, and its metadata, source, language and length. A logistic model per
view is fitted on labelled documents; then, round by round, each gives all
unlabelled documents it is sure of, with its label, to the other. These are
scored, and their gradients summed, in Spark tasks over the stored views of all
documents. Both views are calibrated on labelled documents held back, and joined
by a last logistic model, which scores all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.decontamination import NOT_WORD
from wordloom.llm.repeats import Hashes
from wordloom.llm.texts import (
    BASE,
    BYTE_CODE,
    LOWER,
    SMALL_BLOCK,
    blocks,
    gives_back,
    mixed,
    opened,
    shipped,
    word_hashes,
    words_of,
)
from wordloom.scratch import new_path, remove

MAX_LABELLED = 20_000  # bound of the labelled documents fitted on; unlabelled ones have none
TELLING = 300  # words and word ends of each target
SIGNIFICANT = 30.0  # chi-squared from which one is telling
ROUNDS = 3
SURE = 0.97  # probability from which a view passes a document on
PASSED_ON = 0.1  # of the weight of the labelled ones, at most, by each view in a round
STEPS = 12  # of Newton's method, at most
TEAM = 128  # tasks whose sums are added up before they go on
HELD_BACK = 5  # one labelled document in so many is for calibration
REJECT = 0.5
CALIBRATION_PENALTY = 0.01  # two columns need little

SYMBOLS = b"|!?%#&$*_~<>{}[]()/\\@=+:;,.\"'-"
ENDS = (3, 4, 5, 6, 8)  # bytes of word beginnings and ends that may be telling

TARGETS = ("low", "toxic")
META = "source string, lang string, n_chars bigint"
SCORES = "low_score double, toxic_score double"


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shape statistics of each text of a block."""
    n = len(offsets) - 1
    starts, ends, first = words_of(data, offsets)
    words = np.diff(first).astype(np.float64)
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    size = np.diff(offsets).astype(np.float64)

    def rate(mask: np.ndarray) -> np.ndarray:
        return np.bincount(row_of_byte[mask], minlength=n) / np.maximum(words, 1)

    columns = [rate(data == s) for s in SYMBOLS]
    columns.append(rate((data >= 0x41) & (data <= 0x5A)))
    columns.append(rate((data >= 0x30) & (data <= 0x39)))
    columns.append(rate(data == 0x0A))
    columns.append(rate(data >= 0x80))
    columns.append(size / np.maximum(words, 1) / 10)
    hashes = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(n), np.diff(first))
    again = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    columns.append(np.bincount(row[1:][again], minlength=n) / np.maximum(words, 1))
    columns.append(np.bincount(row[_once(row, hashes)], minlength=n) / np.maximum(words, 1))
    shape = np.stack(columns, axis=1)
    shape[:, : len(SYMBOLS)] = np.minimum(shape[:, : len(SYMBOLS)], 4)
    return np.concatenate([shape, np.sqrt(np.minimum(shape, 4))], axis=1).astype(np.float32)


def _once(row: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Places that hold each pair of row and token once."""
    return np.unique(mixed(token + row.astype(np.uint64) * np.uint64(BASE)), return_index=True)[1]


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of lower-case words, then of their beginnings and ends of each length."""
    data = LOWER[data]
    starts, ends, first = words_of(data, offsets, NOT_WORD)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    hashes = Hashes(BYTE_CODE[data])
    yield row, hashes.of(starts, ends)
    for size in ENDS:
        long = ends - starts > size
        yield row[long], hashes.of(starts[long], starts[long] + size) + np.uint64(size)
        yield row[long], hashes.of(ends[long] - size, ends[long]) + np.uint64(64 + size)


def _token_counts(shared) -> Callable:
    """(token, n, low, toxic): documents of a task with each token, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = shared.value
        held = []
        for part, data, offsets in blocks(batches, limit=SMALL_BLOCK):
            own = np.array([labels.get(i, (0, 0)) for i in part.column("doc_id").to_pylist()])
            for row, token in tokens_of(data, offsets):
                once = _once(row, token)
                row = row[once]
                held.append((token[once], own[row, 0] == 1, own[row, 1] == 1))
        if held:
            token, low, toxic = (np.concatenate(x) for x in zip(*held))
            token, at, n = np.unique(token, return_inverse=True, return_counts=True)
            counts = [np.bincount(at, weights=x, minlength=len(token)) for x in (low, toxic)]
            columns = [token.view(np.int64), n, *(c.astype(np.int64) for c in counts)]
            yield pa.record_batch([pa.array(c) for c in columns], names=["token", "n", "low", "toxic"])

    return gives_back(run)


@dataclass
class Logistic:
    """Weights over standardised columns, the constant last."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> Logistic:
        """By Newton steps; the penalty is on the squares of all weights but the constant."""
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        w = np.zeros(x.shape[1] + 1)
        w[-1] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
        model = cls(mean, scale, w)
        for _ in range(STEPS):
            if model.step(*model.sums(x, y), penalty) < 1e-4:
                break
        return model

    def sums(
        self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of the weighted loss over these rows, without the penalty."""
        z = np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)
        z = z.astype(np.float64)
        p = _sigmoid(z @ self.weights)
        slope = z.T @ (weight * (p - y))
        bend = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z
        return slope, bend

    def step(self, slope: np.ndarray, bend: np.ndarray, penalty: float = 1.0) -> float:
        """Take one Newton step; the largest change of a weight."""
        ridge = np.full(len(self.weights), penalty)
        ridge[-1] = 1e-6
        step = np.linalg.solve(bend + np.diag(ridge), slope + ridge * self.weights)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        self.weights = self.weights - step
        return float(np.abs(step).max())

    def rescaled(self, mean: np.ndarray, scale: np.ndarray) -> Logistic:
        """The same function over columns standardised anew."""
        plain = self.weights[:-1] / self.scale
        constant = self.weights[-1] + plain @ (mean - self.mean)
        return Logistic(mean, scale, np.append(plain * scale, constant))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Target:
    """The joined model of one target."""

    text: Logistic
    meta: Logistic
    calibration: list[Logistic]
    joined: Logistic

    def probability(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        logits = [self.text.logit(text), self.meta.logit(meta)]
        views = [c.logit(v[:, None]) for c, v in zip(self.calibration, logits)]
        return _sigmoid(self.joined.logit(np.stack(views, axis=1)))


@dataclass
class Model:
    """What scoring needs: telling tokens, known metadata values, the model of each target."""

    tokens: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros((0, len(TARGETS))))
    values: dict[str, dict[str, int]] = field(default_factory=dict)
    targets: dict[str, Target | None] = field(default_factory=dict)

    def text_view(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        shape = statistics(data, offsets)
        found = np.zeros((len(offsets) - 1, len(self.tokens)), dtype=np.float32)
        if len(self.tokens):
            for row, token in tokens_of(data, offsets):
                at = np.minimum(np.searchsorted(self.tokens, token), len(self.tokens) - 1)
                hit = self.tokens[at] == token
                found[row[hit], at[hit]] = 1
        # Of what is found, the sum and the most that speaks for each target.
        sums = found @ self.odds.astype(np.float32)
        most = [
            (found * np.maximum(o, 0).astype(np.float32)).max(axis=1, initial=0) for o in self.odds.T
        ]
        return np.concatenate([shape, sums, np.stack(most, axis=1)], axis=1)

    def meta_view(self, source: list, lang: list, n_chars: list) -> np.ndarray:
        columns = []
        for name, rows in (("source", source), ("lang", lang)):
            known = self.values.get(name, {})
            view = np.zeros((len(rows), len(known)), dtype=np.float32)
            for i, value in enumerate(rows):
                if value in known:
                    view[i, known[value]] = 1
            columns.append(view)
        size = np.log1p([max(n or 0, 0) for n in n_chars])
        columns.append(np.stack([size, [n is None for n in n_chars]], axis=1))
        return np.concatenate(columns, axis=1).astype(np.float32)


@dataclass
class Taker:
    """A view of a target while it learns, and what the other view passed on to it.

    ``givers`` has the other view's model, its calibration and the weight of each
    document it passes on, round by round. ``moments`` are the weighted sums of
    ones, columns and their squares over all it is fitted on.
    """

    target: int
    view: int
    model: Logistic
    moments: list
    givers: list[tuple[Logistic, Logistic, float]] = field(default_factory=list)

    def passed(self, views: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and weight of each document, from the first round that was sure of it."""
        free = label < 0
        y, weight = np.zeros(len(label)), np.zeros(len(label))
        for model, checked, each in self.givers:
            p = _sigmoid(checked.logit(model.logit(views[1 - self.view])[:, None]))
            sure = free & (np.maximum(p, 1 - p) >= SURE)
            y[sure] = p[sure] > 0.5
            weight[sure] = each
            free &= ~sure
        return y, weight


def _matrices(part: pa.RecordBatch | pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """Both views and the labels of stored rows."""
    views = [
        np.frombuffer(b"".join(part.column(c).to_pylist()), np.float32).reshape(part.num_rows, -1)
        for c in ("text_view", "meta_view")
    ]
    return views, np.stack([part.column(c).to_numpy() for c in TARGETS], axis=1)


def _moments(x: np.ndarray) -> list:
    x = x.astype(np.float64)
    return [float(len(x)), x.sum(axis=0), (x * x).sum(axis=0)]


def _passed_sums(shared, counting: bool) -> Callable:
    """What a task's unlabelled documents add for each taker: weight, gradient and Hessian.

    Or else, counting, the moments of those with a weight.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        takers = opened(shared)
        sums: list = [[0.0, 0.0, 0.0] for _ in takers]
        for part in batches:
            if not part.num_rows:
                continue
            views, label = _matrices(part)
            for taker, own in zip(takers, sums):
                y, weight = taker.passed(views, label[:, taker.target])
                taken = weight > 0
                x = views[taker.view][taken]
                if counting:
                    more = _moments(x)
                else:
                    more = [weight.sum(), *taker.model.sums(x, y[taken], weight[taken])]
                own[:] = [a + b for a, b in zip(own, more)]
        columns = zip(*((n, np.array(slope).tobytes(), np.array(bend).tobytes()) for n, slope, bend in sums))
        weights, slopes, bends = columns
        task = TaskContext.get().partitionId()
        yield pa.record_batch(
            [
                pa.array([task] * len(takers), pa.int32()),
                pa.array(range(len(takers)), pa.int32()),
                pa.array(weights, pa.float64()),
                pa.array(slopes, pa.binary()),
                pa.array(bends, pa.binary()),
            ],
            names=["task", "taker", "n", "slope", "bend"],
        )

    return gives_back(run)


SUMS = "task int, taker int, n double, slope binary, bend binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows (team, taker, task) one for each team and taker, added up in their order."""
    key, own = None, [0.0, None, None]

    def out() -> pa.RecordBatch:
        n, slope, bend = own
        columns = [pa.array([x], k) for x, k in zip(key, (pa.int32(), pa.int32()))]
        columns.append(pa.array([n], pa.float64()))
        columns += [pa.array([b"" if x is None else x.tobytes()], pa.binary()) for x in (slope, bend)]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SUMS.split(", ")])

    for batch in batches:
        for row in batch.to_pylist():
            if (row["team"], row["taker"]) != key:
                if key is not None:
                    yield out()
                key, own = (row["team"], row["taker"]), [0.0, None, None]
            if row["n"]:
                own[0] += row["n"]
                for place, name in ((1, "slope"), (2, "bend")):
                    more = np.frombuffer(row[name])
                    own[place] = more if own[place] is None else own[place] + more
    if key is not None:
        yield out()


def _over_unlabelled(views: DataFrame, takers: list[Taker], counting: bool = False) -> list:
    """The sums of each taker over all stored rows, added up in the order of tasks.

    Tasks give their sums to teams of TEAM, and these to teams in turn, so that
    the driver gets at most TEAM rows for each taker, whatever the number of tasks.
    """
    shared = shipped(views.sparkSession, takers)
    rows = views.mapInArrow(_passed_sums(shared, counting), SUMS)
    tasks = views.rdd.getNumPartitions()
    while tasks > TEAM:
        rows = rows.withColumn("team", F.floor(F.col("task") / TEAM).cast("int"))
        rows = rows.repartition("team", "taker").sortWithinPartitions("team", "taker", "task")
        rows = rows.select("team", "taker", "task", "n", "slope", "bend").mapInArrow(_added, SUMS)
        tasks = -(-tasks // TEAM)
    found = rows.toArrow()
    shared.destroy()
    sums: list = [[0.0, 0.0, 0.0] for _ in takers]
    for row in found.sort_by([("task", "ascending"), ("taker", "ascending")]).to_pylist():
        own = sums[row["taker"]]
        if row["n"]:
            slope, bend = np.frombuffer(row["slope"]), np.frombuffer(row["bend"])
            own[0] += row["n"]
            own[1] = own[1] + slope
            own[2] = own[2] + (bend if counting else bend.reshape(len(slope), -1))
    return sums


def co_train(
    stored: DataFrame, views: list[np.ndarray], labels: np.ndarray, held: np.ndarray
) -> list[Target | None]:
    """The model of each target; ``stored`` has the views of all documents.

    ``views`` and ``labels`` are those of the labelled documents, label -1 is
    none; ``held`` marks rows for calibration. A view is only as sure as it
    proves on the rows held back, so one that knows nothing passes nothing on.
    All unlabelled documents it is sure of count, with equal weights that sum to
    no more than a tenth of the labelled ones. None if either class is missing
    among the rows to fit on.
    """
    fitted, judged, takers = {}, {}, []
    for target in range(len(TARGETS)):
        label = labels[:, target]
        rows = np.flatnonzero((label >= 0) & ~held)
        if len(np.unique(label[rows])) < 2:
            continue
        fitted[target] = rows
        judged[target] = np.flatnonzero((label >= 0) & held)
        if len(np.unique(label[judged[target]])) < 2:
            judged[target] = rows
        for view, x in enumerate(views):
            takers.append(Taker(target, view, Logistic.fit(x[rows], label[rows]), _moments(x[rows])))

    def checked(taker: Taker) -> tuple[np.ndarray, Logistic]:
        rows = judged[taker.target]
        logit = taker.model.logit(views[taker.view][rows])[:, None]
        return logit, Logistic.fit(logit, labels[rows, taker.target], CALIBRATION_PENALTY)

    for _ in range(ROUNDS if takers else 0):
        # Takers of a target stand side by side, so the other view is at place ^ 1.
        now = [(takers[i ^ 1].model, checked(takers[i ^ 1])[1]) for i in range(len(takers))]
        tried = [
            Taker(t.target, t.view, t.model, [], [*((m, c, 0.0) for m, c, _ in t.givers), (*giver, 1.0)])
            for t, giver in zip(takers, now)
        ]
        sure = _over_unlabelled(stored, tried, counting=True)
        if not any(n for n, _, _ in sure):
            break  # the models stay as they are, and so would what they are sure of
        moving = []
        for taker, (model, check), found in zip(takers, now, sure):
            if found[0]:
                each = min(1.0, PASSED_ON * len(fitted[taker.target]) / found[0])
                taker.givers.append((model, check, each))
                taker.moments = [a + each * b for a, b in zip(taker.moments, found)]
                mean, squares = (m / taker.moments[0] for m in taker.moments[1:])
                scale = np.sqrt(np.maximum(squares - mean**2, 0)) + 1e-3
                # A new model, as the one of this round may have given to the other view.
                taker.model = taker.model.rescaled(mean, scale)
                moving.append(taker)
        for _ in range(STEPS):
            sums = _over_unlabelled(stored, moving)
            still = []
            for taker, (_, slope, bend) in zip(moving, sums):
                rows = fitted[taker.target]
                own = taker.model.sums(views[taker.view][rows], labels[rows, taker.target])
                if taker.model.step(own[0] + slope, own[1] + bend) >= 1e-4:
                    still.append(taker)
            moving = still
            if not moving:
                break
    out: list[Target | None] = [None] * len(TARGETS)
    for text, meta in zip(takers[::2], takers[1::2]):
        y = labels[judged[text.target], text.target]
        (a, by_text), (b, by_meta) = checked(text), checked(meta)
        both = np.stack([by_text.logit(a), by_meta.logit(b)], axis=1)
        joined = Logistic.fit(both, y, CALIBRATION_PENALTY)
        out[text.target] = Target(text.model, meta.model, [by_text, by_meta], joined)
    return out


def _rows(docs: DataFrame, *first: Column) -> DataFrame:
    """``first``, or the id, and the columns in use; metadata that is not there is null."""
    columns = list(first) or [F.col("doc_id").cast("bigint").alias("doc_id")]
    columns.append(F.col("text"))
    for name, kind in (f.split() for f in META.split(", ")):
        has = name in docs.columns
        columns.append((F.col(name) if has else F.lit(None)).cast(kind).alias(name))
    return docs.select(columns)


def _views(shared) -> Callable:
    """The views of all documents, as bytes of their arrays, and the labels drawn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = opened(shared)
        for part, data, offsets in blocks(batches, limit=SMALL_BLOCK):
            text = model.text_view(data, offsets)
            meta = model.meta_view(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            ids = part.column("doc_id")
            label = np.array([known.get(i, (-1, -1)) for i in ids.to_pylist()], np.int32).reshape(-1, 2)
            yield pa.record_batch(
                [
                    ids,
                    *(pa.array(c, pa.int32()) for c in label.T),
                    *(pa.array([row.tobytes() for row in v], pa.binary()) for v in (text, meta)),
                ],
                names=["doc_id", *TARGETS, "text_view", "meta_view"],
            )

    return gives_back(run)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most so many labelled documents, drawn by a hash of the id, and all others.

    Rows of ``labels`` without an id or without both labels are left out, and of
    those that repeat an id the greatest labels count. Documents with a label in
    the draw are found by a broadcast of the drawn ids. The views of all documents
    are in the shared folder while this runs.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    drawn = (
        labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
        .collect()
    )
    known = {
        r["doc_id"]: (
            -1 if r["quality"] is None else int(r["quality"] == 0),
            -1 if r["toxic"] is None else int(r["toxic"] == 1),
        )
        for r in drawn
    }
    model = Model()
    if not known:
        return model
    rows = _rows(docs)
    ids = spark.createDataFrame([(i,) for i in known], "doc_id bigint")
    labelled = rows.join(F.broadcast(ids), "doc_id", "left_semi")
    counts = labelled.select("doc_id", "text").mapInArrow(
        _token_counts(context.broadcast(known)), "token bigint, n bigint, low bigint, toxic bigint"
    )
    counts = counts.groupBy("token").agg(*(F.sum(c).alias(c) for c in ("n", "low", "toxic")))
    total = len(known)
    odds: dict[int, list[float]] = {}
    sizes = [sum(v[place] == 1 for v in known.values()) for place in range(len(TARGETS))]
    for target, size in zip(TARGETS, sizes):
        share = size / total
        if not 0 < share < 1:
            continue
        # Chi-squared of a token against the target, with half a document added to each side.
        expected = F.col("n") * share
        score = (F.abs(F.col(target) - expected) - 0.5) ** 2 * (
            1 / (expected + 0.5) + 1 / (F.col("n") - expected + 0.5)
        )
        best = counts.select("*", score.alias("s")).where(F.col("s") >= SIGNIFICANT)
        for r in best.orderBy(F.desc("s"), "token").limit(TELLING).collect():
            odds[r["token"]] = [
                np.log((r[t] + 0.5) / (own + 1)) - np.log((r["n"] - r[t] + 0.5) / (total - own + 1))
                for t, own in zip(TARGETS, sizes)
            ]
    tokens = np.array(list(odds), dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    model.tokens, model.odds = tokens[order], np.array(list(odds.values())).reshape(-1, 2)[order]
    for name in ("source", "lang"):
        common = rows.groupBy(name).count().where(F.col(name).isNotNull())
        common = common.orderBy(F.desc("count"), name).limit(256).collect()
        model.values[name] = {r[name]: i for i, r in enumerate(common)}
    path = new_path(spark, "quality_views")
    try:
        shared = shipped(spark, (model, known))
        rows.mapInArrow(
            _views(shared),
            "doc_id bigint, low int, toxic int, text_view binary, meta_view binary",
        ).write.parquet(path)
        shared.destroy()
        stored = spark.read.parquet(path)
        # One document for each labelled id, however many rows repeat it.
        row = F.struct("low", "toxic", "text_view", "meta_view")
        found = stored.where("low >= 0 OR toxic >= 0").groupBy("doc_id").agg(F.min(row).alias("row"))
        found = found.select("doc_id", "row.*").toArrow()
        if found.num_rows:
            order = [(c, "ascending") for c in ("doc_id", "text_view", "meta_view")]
            found = found.sort_by(order)
            views, label = _matrices(found)
            held = (found.column("doc_id").to_numpy() * 0x9E3779B1 >> 7) % HELD_BACK == 0
            model.targets = dict(zip(TARGETS, co_train(stored, views, label, held)))
    finally:
        remove(spark, path)
    return model


def _scorer(shared, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(shared)
        for part, data, offsets in blocks(batches, limit=SMALL_BLOCK):
            text = model.text_view(data, offsets)
            meta = model.meta_view(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")))
            scores = []
            for name in TARGETS:
                target = model.targets.get(name)
                p = target.probability(text, meta) if target else np.zeros(part.num_rows)
                scores.append(pa.array(p.astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), *scores],
                names=[*names, "low_score", "toxic_score"],
            )

    return gives_back(run)


def score(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """(doc_id, low_score, toxic_score, kept), one row per row of ``docs``.

    The scores are probabilities of low quality (label ``quality`` 0) and of
    toxicity (``toxic`` 1); a document is kept if both are below ``reject``.
    Without labels of both kinds for a target its score is 0. Null texts count
    as empty, metadata may be null or missing. Other columns are not read.
    """
    shared = shipped(docs.sparkSession, fit(docs, labels))
    scored = _rows(docs).mapInArrow(_scorer(shared, ["doc_id"]), f"doc_id bigint, {SCORES}")
    return scored.withColumn("kept", F.greatest("low_score", "toxic_score") < reject)


def _accepter(shared, reject: float) -> Callable:
    """The whole rows that are kept, block by block; the text is read from the row itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(shared)
        for batch in batches:
            doc = batch.column("doc")
            columns = {"doc": doc, "text": pc.struct_field(doc, "text")}
            columns |= {c: batch.column(c) for c in ("source", "lang", "n_chars")}
            whole = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
            for part, data, offsets in blocks(iter([whole]), limit=SMALL_BLOCK):
                text = model.text_view(data, offsets)
                meta = model.meta_view(
                    *(part.column(c).to_pylist() for c in ("source", "lang", "n_chars"))
                )
                keep = np.ones(part.num_rows, dtype=bool)
                for target in model.targets.values():
                    if target:
                        keep &= target.probability(text, meta).astype(np.float64) < reject
                kept = part.column("doc").filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([kept], names=["doc"])

    return gives_back(run)


def accepted(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs``, all columns, that are kept. Rejected rows do not leave their task."""
    shared = shipped(docs.sparkSession, fit(docs, labels))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = _rows(docs, whole).drop("text")
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_accepter(shared, reject), f"doc {kind}").select("doc.*")
