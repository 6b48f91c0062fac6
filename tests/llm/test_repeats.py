import re
from collections import defaultdict

import pytest

from tests.llm.cases import documents, frame
from wordloom.llm import repeats, substring_dedup, suffix_dedup
from wordloom.llm.texts import identified

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def ordered(spark, rows):
    """The documents in order: (id without null, hash of the text, id, text)."""
    keyed = identified(frame(spark, rows)).collect()
    return sorted({(r["_id"], r["_h"], r["doc_id"], r["text"]) for r in keyed}, key=lambda r: r[:2])


def brute(spark, rows, units, window, own):
    """{(doc_id, text): which units are removed}."""
    docs = [(i, h, doc, text, units((text or "").encode())) for i, h, doc, text in ordered(spark, rows)]
    first = defaultdict(list)
    for place, (i, _, _, _, parts) in enumerate(docs):
        for p in range(len(parts) - window + 1):
            first[tuple(parts[p : p + window])].append((i, place, p))
    out = {}
    for place, (i, _, doc, text, parts) in enumerate(docs):
        gone = [False] * len(parts)
        for p in range(len(parts) - window + 1):
            least = first[tuple(parts[p : p + window])][0]
            if (least[1:] < (place, p)) if own else (least[0] < i):
                gone[p : p + window] = [True] * window
        out[doc, text] = parts, gone
    return out


def check_words(spark, rows, window, gram):
    want = brute(spark, rows, WORDS.findall, window, False)
    got = substring_dedup.without_repeated_words(frame(spark, rows), window, gram)
    expected = []
    for doc, text in rows:
        parts, gone = want[doc, text]
        kept = b" ".join(p for p, g in zip(parts, gone) if not g)
        expected.append((doc, len(parts), sum(gone), kept))
    assert sorted(map(_plain, got.collect()), key=repr) == sorted(expected, key=repr)
    assert any(row[2] for row in expected)


def check_bytes(spark, rows, window, gram):
    want = brute(spark, rows, list, window, True)
    got = suffix_dedup.without_repeated_bytes(frame(spark, rows), window, gram)
    expected = []
    for doc, text in rows:
        parts, gone = want[doc, text]
        spans = sum(g and not (n and gone[n - 1]) for n, g in enumerate(gone))
        kept = bytes(p for p, g in zip(parts, gone) if not g)
        expected.append((doc, len(parts), sum(gone), spans, kept))
    assert sorted(map(_plain, got.collect()), key=repr) == sorted(expected, key=repr)
    assert any(row[2] for row in expected)


def _plain(row):
    return tuple(bytes(x) if isinstance(x, bytearray) else x for x in row)


@pytest.mark.parametrize("window, gram", [(50, 12), (6, 3)])
def test_words(spark, window, gram):
    check_words(spark, documents(), window, gram)


@pytest.mark.parametrize("window, gram", [(100, 32), (20, 8)])
def test_bytes(spark, window, gram):
    check_bytes(spark, documents(), window, gram)


def test_large_groups_go_by_window(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LARGE_GROUP", 1)
    monkeypatch.setattr(substring_dedup.repeated_spans, "__defaults__", (50, 12, 1))
    monkeypatch.setattr(repeats.removed_spans, "__defaults__", (1,))
    check_words(spark, documents(), 50, 12)
    check_bytes(spark, documents(), 100, 32)
    monkeypatch.setattr(substring_dedup, "fits_broadcast", lambda rows: False)
    check_words(spark, documents(), 50, 12)


def test_small_tiles_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "TILE", 64)
    monkeypatch.setattr(repeats, "TASK_SEGMENTS", 10)
    check_bytes(spark, documents(), 20, 8)
    check_words(spark, documents(), 6, 3)


def test_frequent_anchors_are_dealt_by_content(spark, monkeypatch):
    line = documents()[0][1]
    rows = documents() + [(100 + i, f"a{i} b{i} {line} c{i % 3}") for i in range(12)]
    for most in (0, 1, 3):
        monkeypatch.setattr(repeats, "TASK_ANCHOR", most)
        check_words(spark, rows, 50, 12)
        check_words(spark, rows, 6, 3)
        check_bytes(spark, rows, 100, 32)


def test_documents_that_repeat_themselves(spark, monkeypatch):
    phrase, tail = "Is onhe. ", " ".join(f"t{i}" for i in range(60))
    texts = [phrase * 90, f"a b c {phrase * 70} d", f"{tail} x {tail} y {phrase * 60}", tail, phrase * 40]
    texts += [f"{tail} {tail} {tail} z", f"q {phrase * 30} {tail} {phrase * 33}", "x y z " * 50]
    rows = [(30 - i, text) for i, text in enumerate(texts)] + [(40, texts[2]), (40, texts[5])]
    rows += [(40, texts[2]), (None, texts[1]), *documents()]
    for most in (0, 64):
        monkeypatch.setattr(repeats, "TASK_ANCHOR", most)
        check_words(spark, rows, 50, 12)
        check_words(spark, rows, 6, 3)
    check_bytes(spark, rows[:14], 100, 32)


def test_loser_tree_merges_front_coded_runs():
    lines = [[b"", b"a", b"ab", b"abc"], [b"abd", b"b"], [], [b"ab", b"ab", b"zz"]]
    runs = [suffix_dedup.front_coded(x) for x in lines]
    got = list(suffix_dedup.merge(runs))
    texts = [x[2] for x in got]
    assert texts == sorted(b for x in lines for b in x)
    for before, (_, _, text, shared) in zip(texts, got[1:]):
        assert text[:shared] == before[:shared] and text[: shared + 1] != before[: shared + 1] or text == before


def test_cut_keeps_rows_columns_and_whole_characters(spark):
    docs = frame(spark, documents())
    got = suffix_dedup.with_repeats_cut(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[20] == "" and texts[50] is None and texts[53] == "one"
    assert texts[61] == "a" and set(texts[63]) <= {"é", "x"}


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert substring_dedup.without_repeated_words(docs).count() == 0
    assert suffix_dedup.without_repeated_bytes(docs).count() == 0

