import base64
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import documents, frame
from tests.llm.katz import Model
from wordloom.llm import backoff, decontamination, fingerprints, near_duplicates, quality

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shingles(text, size):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(rows, size, percent):
    """(n_shingles, component, kept) of each row by comparing all pairs."""
    ids = [float("-inf") if i is None else i for i, _ in rows]
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    out = []
    for i, (doc, _) in enumerate(rows):
        low = least[root(i)]
        out.append((doc, len(sets[i]), None if low == float("-inf") else low, low == ids[i]))
    return out


def test_near_duplicates(spark):
    rows = documents()
    for size, percent in ((3, 85), (5, 80), (1, 70)):
        got = near_duplicates.near_duplicates(frame(spark, rows), size, percent).drop("_id", "_h")
        assert rows_of(got) == sorted(components(rows, size, percent), key=repr)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 2)
    monkeypatch.setattr(near_duplicates, "GROUP", 2)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(24):  # edits add up, so that few are linked with the first
        own = list(words)
        for k in range(i % 6):
            own[7 * k + (i % 3)] = f"e{i % 4}{k}"
        rows.append((i, " ".join(own)))
    got = near_duplicates.near_duplicates(frame(spark, rows), 3, 85).drop("_id", "_h")
    assert rows_of(got) == sorted(components(rows, 3, 85), key=repr)


def test_kept_documents_keep_their_columns(spark):
    docs = frame(spark, documents())
    got = near_duplicates.without_near_duplicates(docs, 5, 80)
    assert got.columns == docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert 20 not in ids and 13 in ids and 30 not in ids and 50 in ids and 51 in ids


def test_one_row_of_a_component_stays_whatever_the_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join([*words[:i], "edit", *words[i + 1 :]]) for i in range(12)]
    far = " ".join(f"v{i}" for i in range(60))
    rows = [(None, t) for t in near] + [(None, far), (None, far), (7, far + " a"), (None, ""), (8, None)]
    rows += [(9, t.replace("w", "x")) for t in near]
    left = near_duplicates.without_near_duplicates(frame(spark, rows), 3, 70).collect()
    kept = [(r["doc_id"], (r["text"] or "")[-3:-2]) for r in left]
    assert sorted(kept, key=repr) == sorted([(None, "w"), (None, "v"), (None, ""), (8, ""), (9, "x")], key=repr)


def contaminated(docs, items, size=10):
    windows = []
    for item, text in items:
        own = NAMES.findall((text or "").translate(LOWER))
        for i in range(max(1, len(own) - size + 1) if own else 0):
            windows.append((own[i : i + size], "null" if item is None else str(item)))
    out = []
    for doc, text in docs:
        words, hit, found = NAMES.findall((text or "").translate(LOWER)), set(), set()
        for window, item in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        out.append((doc, len(words), len(hit), len(found), sorted(found), bool(hit)))
    return out


def items():
    rows = documents()
    return [(1, rows[0][1]), (2, "One"), (None, rows[5][1]), (3, None), (2, "two words"), (4, "-,-")]


def test_contamination(spark):
    rows = documents()
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    docs = frame(spark, rows).drop("hits")
    assert rows_of(decontamination.contamination(docs, bench)) == sorted(contaminated(rows, items()), key=repr)


def test_contamination_in_blocks_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_SYMBOLS", 20)
    rows = documents()
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    docs = frame(spark, rows).select("doc_id", "text")
    got = decontamination.with_hits(docs, bench, block_bytes=600).collect()
    want = {(d, n, tuple(found)) for d, n, _, _, found, _ in contaminated(rows, items())}
    assert {(r["doc_id"], r["hits"]["n_words"], tuple(r["hits"]["items"])) for r in got} == want
    covered = sum(s["last"] - s["first"] for r in got for s in r["hits"]["spans"])
    assert covered == sum(x[2] for x in contaminated(rows, items()))


def test_spans_are_cut_and_columns_stay(spark):
    docs = frame(spark, documents())
    bench = spark.createDataFrame([(1, documents()[0][1])], "item_id bigint, text string")
    got = decontamination.without_benchmark(docs, bench)
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert NAMES.findall(texts[21]) == ["more"] and texts[50] is None and texts[54] == "One"


def test_without_benchmark_or_documents(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    found = decontamination.contamination(frame(spark, documents()).drop("hits"), none)
    assert found.where("n_hit > 0 OR n_items > 0").count() == 0 and found.count() == len(documents())
    assert decontamination.contamination(frame(spark, []).drop("hits"), none).count() == 0
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0
    assert fingerprints.fingerprint_documents(frame(spark, [])).count() == 0
    assert backoff.backoff_scores(frame(spark, [])).count() == 0


def test_backoff(spark):
    rows = documents()
    model = Model(rows)
    want = sorted((model.row(*r) for r in rows), key=repr)
    got = sorted((r.asDict() for r in backoff.backoff_scores(frame(spark, rows)).collect()), key=repr)
    for a, b in zip(sorted(got, key=_order), sorted(want, key=_order), strict=True):
        for name, value in b.items():
            assert a[name] == value or abs(a[name] - value) < 1e-9 * max(1, abs(value)), name


def _order(row):
    return str(row["doc_id"]), row["n_tokens"], round(row["score"], 6)


def test_backoff_sums_to_one():
    model = Model(documents())
    for h in list(model.pairs)[:20]:
        total = sum(model.probability(h, w) for w in model.count) + model.probability(h, ("unknown",))
        assert abs(total - 1) < 1e-9


def test_fingerprints(spark):
    rows = [r for r in documents() if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(frame(spark, rows)).collect()}
    for (doc, text), (_, after) in zip(order, [*order[1:], order[0]]):
        text, after, row = text or "", after or "", got[doc]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert row["n_chars"] == len(text) and row["edited_text"] == edited
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = set(fingerprints.digests(text).tolist()), set(fingerprints.digests(other).tolist())
            assert row[name] == (len(a & b) / len(a | b) if a | b else 1.0)
    assert len({len(base64.b64decode(r["fingerprint"])) for r in got.values()}) == 1
    empty = {got[i]["fingerprint"] for i in (50, 51)}
    assert len(empty) == 1


def paragraphs(text):
    """The numbered paragraphs of a text, without digests."""
    seen, out = Counter(), set()
    for line in re.split(r"(?<=[.!?])\s+|\n+", text or ""):
        for at in range(0, len(line), 256):
            part = line[at : at + 256]
            out.add((part, seen[part]))
            seen[part] += 1
    return out


def test_fingerprints_equal_sets_of_paragraphs(spark):
    """Null and repeated ids as well: rows of one id follow each other by a hash of their text."""
    rows = documents()
    df = frame(spark, rows)
    hashed = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order = sorted(hashed, key=lambda r: (-(2**63) if r[0] is None else r[0], -r[2]), reverse=True)
    want = []
    for row, after in zip(order, [*order[1:], order[0]]):
        text, following = row["text"] or "", after["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, alike = paragraphs(text), []
        for other in (paragraphs(edited), paragraphs(following)):
            alike.append(len(own & other) / len(own | other) if own | other else 1.0)
        want.append((row["doc_id"], len(text), edited, *alike))
    got = fingerprints.fingerprint_documents(df)
    got = got.select("doc_id", "n_chars", "edited_text", "near_edited", "near_next").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_changes_between_versions(spark):
    rows = [(i, t) for i, t in documents() if i is not None and i >= 20]
    new = [(i, (t or "") + "\nA new paragraph.") for i, t in rows if i % 2] + [(999, "x")]
    found = fingerprints.paragraph_changes(frame(spark, rows), frame(spark, new))
    old = dict(rows)
    got = {r["doc_id"]: r for r in found.collect()}
    assert set(got) == {i for i, _ in new if i in old}
    for i, r in got.items():
        a, b = (set(fingerprints.digests(x or "").view(np.int64).tolist()) for x in (old[i], dict(new)[i]))
        assert set(r["removed"]) == a - b and set(r["added"]) == b - a
        assert len(r["added"]) == len(paragraphs(dict(new)[i]) - paragraphs(old[i]))
    empty = frame(spark, [])
    assert fingerprints.paragraph_changes(empty, empty).count() == 0


def test_peeling_gives_digests_and_sides():
    rng = np.random.default_rng(4)
    a = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 3, 40, 900)]
    b = [np.concatenate([g[1:], rng.integers(0, 2**63, len(g) // 3).astype(np.uint64)]) for g in a]
    only_a, only_b = fingerprints.differences(a, b)
    for x, y, p, q in zip(a, b, only_a, only_b):
        assert set(p.tolist()) == set(x.tolist()) - set(y.tolist())
        assert set(q.tolist()) == set(y.tolist()) - set(x.tolist())


def test_digests_that_never_peel_are_compared(monkeypatch):
    """Every digest in the same three cells, whatever the size of the sketch."""
    monkeypatch.setattr(
        fingerprints, "_places", lambda keys, cells: [np.full(len(keys), i * (cells // 3)) for i in range(3)]
    )
    a, b = [np.arange(9, dtype=np.uint64)], [np.arange(5, 20, dtype=np.uint64)]
    only_a, only_b = fingerprints.differences(a, b)
    assert only_a[0].tolist() == [0, 1, 2, 3, 4] and only_b[0].tolist() == list(range(9, 20))


def test_sketches_recover_differences():
    rng = np.random.default_rng(1)
    groups = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 5, 400, 3000)]
    others = [np.concatenate([g[: len(g) // 2], g[:0]]) for g in groups]
    got = fingerprints.likeness(groups, others)
    want = [len(b) / len(a) if len(a) else 1.0 for a, b in zip(groups, others)]
    assert np.allclose(got, want)


def labelled(n):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(n):
        low, toxic = i % 5 == 0, i % 7 == 0
        words = [f"word{rng.integers(50)}" for _ in range(30)]
        if low:
            words = [w + "|||" for w in words]
        if toxic:
            words[3], words[9] = "vilest", "vilely"
        docs.append((i, " ".join(words)))
        labels.append((i, int(not low), int(toxic)))
    return docs, labels


def test_quality(spark):
    docs, labels = labelled(700)
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id bigint, quality int, toxic int")
    rows = frame(spark, [*docs, (None, None), (None, docs[1][1]), (9000, "")])
    got = quality.score(rows, known)
    assert got.count() == len(docs) + 3
    kept = {r["doc_id"]: r["kept"] for r in got.where("doc_id < 700").collect()}
    wrong = [i for i, q, t in labels if kept[i] != (q == 1 and t == 0)]
    assert len(wrong) <= 7
    accepted = quality.accepted(rows, known)
    assert accepted.columns == rows.columns
    assert accepted.where("doc_id < 700").count() == sum(kept.values())


def test_sums_by_teams_of_tasks(spark, monkeypatch):
    """The same models, however many levels the tasks' sums go through; repeated ids count once."""
    docs, labels = labelled(400)
    known = spark.createDataFrame([x for x in labels if x[0] % 2], "doc_id bigint, quality int, toxic int")
    rows = frame(spark, docs + docs[:60] * 3).repartition(9)
    found = []
    for team in (128, 2):
        monkeypatch.setattr(quality, "TEAM", team)
        scores = quality.score(rows, known).select("doc_id", "low_score", "toxic_score").distinct().collect()
        found.append(np.array(sorted(map(tuple, scores))))
    assert len(found[0]) == 400 and np.allclose(*found, atol=1e-6)


def test_quality_without_labels(spark):
    docs = frame(spark, documents())
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(1, None, None), (None, 1, 0), (10, 1, None)], none.schema)
    for labels in (none, odd):
        assert quality.score(docs, labels).where("kept").count() == len(documents())
    assert quality.score(frame(spark, []), none).count() == 0



def test_all_unlabelled_documents_pass_labels_on(spark):
    """Those stored last too: what the text says of them, the metadata view learns."""
    docs, labels = labelled(700)
    rows = [(i, t, f"src{i % 3}") for i, t in docs]
    good = next(t for i, t in docs if i % 5 and i % 7)
    bad = next(t for i, t in docs if not i % 5 and i % 7)
    rows += [(1000 + i, good, f"src{i % 3}") for i in range(12_000)]
    rows += [(20_000 + i, bad, "late") for i in range(500)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    frames = [
        spark.createDataFrame(r, "doc_id bigint, text string, source string") for r in (rows, rows[::-1])
    ]
    models = [quality.fit(docs, known) for docs in frames]
    found = []
    for model in models:
        late, other = model.targets["low"].meta.logit(model.meta_view(["late", "src1"], [None] * 2, [None] * 2))
        assert late > other + 2
        found.append((late, other))
    assert np.allclose(*found, atol=1e-6)
