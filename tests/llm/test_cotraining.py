"""The rounds of co-training against a plain form of them, with all documents in memory."""

import numpy as np
import pytest

from tests.llm.test_documents import labelled
from wordloom.llm import quality


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Plain:
    """Weighted logistic regression by Newton steps over standardised columns."""

    def __init__(self, x, y, weight, penalty=1.0, steps=100):
        x, weight = x.astype(np.float64), weight.astype(np.float64)
        self.mean = weight @ x / weight.sum()
        self.scale = np.sqrt(np.maximum(weight @ (x * x) / weight.sum() - self.mean**2, 0)) + 1e-3
        z = self.columns(x)
        ridge = np.append(np.full(x.shape[1], penalty), 1e-6)
        self.w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = sigmoid(z @ self.w)
            slope = z.T @ (weight * (p - y)) + ridge * self.w
            bend = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(bend, slope)
            self.w -= step * min(1, 5 / (np.abs(step).max() + 1e-12))

    def columns(self, x):
        return np.append((x - self.mean) / self.scale, np.ones((len(x), 1)), axis=1)

    def logit(self, x):
        return self.columns(x.astype(np.float64)) @ self.w


def plain_rounds(views, label, held):
    """Probabilities of all documents for one target, label -1 being none."""
    fitted, judged = np.flatnonzero((label >= 0) & ~held), np.flatnonzero((label >= 0) & held)
    weights = [np.where(np.isin(np.arange(len(label)), fitted), 1.0, 0.0) for _ in views]
    answers = [np.where(label > 0, 1.0, 0.0) for _ in views]
    models = [Plain(v[fitted], label[fitted], np.ones(len(fitted))) for v in views]

    def checked(model, view):
        return Plain(model.logit(view[judged])[:, None], label[judged], np.ones(len(judged)), quality.CALIBRATION_PENALTY)

    passed = [0, 0]
    for _ in range(quality.ROUNDS):
        checks = [checked(m, v) for m, v in zip(models, views)]
        told = [sigmoid(c.logit(m.logit(v)[:, None])) for c, m, v in zip(checks, models, views)]
        changed = False
        for taker in (0, 1):
            p = told[1 - taker]
            new = (label < 0) & (weights[taker] == 0) & (np.maximum(p, 1 - p) >= quality.SURE)
            passed[taker] += new.sum()
            if new.any():
                weights[taker][new] = min(1, quality.PASSED_ON * len(fitted) / new.sum())
                answers[taker][new] = p[new] > 0.5
                changed = True
        if not changed:
            break
        for taker, view in enumerate(views):
            used = weights[taker] > 0
            models[taker] = Plain(view[used], answers[taker][used], weights[taker][used])
    checks = [checked(m, v) for m, v in zip(models, views)]
    both = np.stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(checks, models, views)], axis=1)
    joined = Plain(both[judged], label[judged], np.ones(len(judged)), quality.CALIBRATION_PENALTY)
    return sigmoid(joined.logit(both)), passed


@pytest.mark.parametrize("informative", [False, True])
def test_scores_equal_plain_rounds(spark, informative):
    """With metadata that tell and with some that do not; unlabelled documents are most of all."""
    docs, labels = labelled(900)
    source = [f"src{i % 3}" if not informative or i % 5 or i % 4 == 1 else "late" for i, _ in docs]
    size = [100] * len(docs)  # the texts' own lengths would tell
    rows = [(i, t, s, n) for (i, t), s, n in zip(docs, source, size)]
    known = [x for x in labels if x[0] % 3 == 0]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint").repartition(6)
    known_df = spark.createDataFrame(known, "doc_id bigint, quality int, toxic int")
    model = quality.fit(frame, known_df)
    got = {r["doc_id"]: (r["low_score"], r["toxic_score"]) for r in quality.score(frame, known_df).collect()}

    data = np.frombuffer("".join(t for _, t in docs).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for _, t in docs])
    views = [
        model.text_view(data, offsets),
        model.meta_view(source, [None] * len(docs), size),
    ]
    ids = np.arange(900)
    held = (ids * 0x9E3779B1 >> 7) % quality.HELD_BACK == 0
    said = {i: (int(q == 0), t) for i, q, t in known}
    for place in range(2):
        label = np.array([said.get(i, (-1, -1))[place] for i in range(900)])
        want, passed = plain_rounds(views, label, held)
        assert np.abs(want - np.array([got[i][place] for i in range(900)])).max() < 0.02
        assert passed[1] > 100  # the text view teaches the metadata view
        if place == 0:
            assert (passed[0] > 50) == informative  # and is taught by it, where metadata tell
