import pytest

from tests.plans import physical_plan
from wordloom.functions import posting_line, surrogate_key
from wordloom.operators import (
    corpus_total,
    last_per_key,
    last_posting_per_word,
    postings,
    rank_terms,
    raw_postings,
    row_postings,
    term_counts,
    tokens,
)
from wordloom.plans import build_index, corpus_tokens
from wordloom.sources import tokens_from_lines

LINES = ['10\tThe cat-dog, the "CAT" runs.', "2\tDog.", "7\t", ""]


@pytest.fixture(scope="module")
def toks(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "value STRING")
    return tokens_from_lines(lines).where("word <> 'the'")


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_counts(toks):
    assert rows(corpus_total(toks)) == [(5,)]
    assert rows(rank_terms(term_counts(toks))) == [("cat", 2), ("dog", 2), ("runs", 1)]


def test_postings(toks):
    posts = postings(toks)
    assert sorted(rows(posts)) == [
        ("cat", 10, 2),
        ("dog", 2, 1),
        ("dog", 10, 1),
        ("runs", 10, 1),
    ]
    assert sorted(rows(raw_postings(toks))).count(("cat", 10, 1)) == 2
    assert sorted(rows(last_posting_per_word(posts))) == [
        ("cat", 10, 2),
        ("dog", 2, 1),
        ("runs", 10, 1),
    ]
    lines = posts.select(posting_line(posts.word, posts.doc_id, posts.occurrences))
    assert "dog 10 1" in {row[0] for row in lines.collect()}


def test_row_postings(spark):
    docs = [(1, 'b a-b "B" c.'), (2, "x"), (3, ""), (4, None), (5, " - "), (6, "a  a a")]
    df = spark.createDataFrame(docs, "doc_id BIGINT, text STRING")
    got = row_postings(df)
    assert sorted(rows(got)) == [
        ("a", 1, 1),
        ("a", 6, 3),
        ("b", 1, 3),
        ("c", 1, 1),
        ("x", 2, 1),
    ]
    assert "Exchange" not in physical_plan(got.where("word <> 'a'"))
    assert got.dtypes == postings(tokens(df)).dtypes


def test_both_ways_to_count_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    by_row = build_index(docs, ["the", "le"], unique_ids=True)
    assert sorted(rows(by_row)) == sorted(rows(build_index(docs, ["the", "le"])))


def test_surrogate_key_is_not_unique(spark):
    pair = spark.createDataFrame([("a1", 2), ("a", 12)], "word STRING, doc_id BIGINT")
    assert {r[0] for r in pair.select(surrogate_key(pair.word, pair.doc_id)).collect()} == {"a12"}


def test_empty_corpus(toks):
    none = toks.where("false")
    assert rows(corpus_total(none)) == [(0,)]
    assert term_counts(none).count() == postings(none).count() == raw_postings(none).count() == 0


def test_total_is_a_bigint(toks):
    assert corpus_total(toks).dtypes == [("occurrences", "bigint")]
    assert dict(raw_postings(toks).dtypes)["occurrences"] == "bigint"


def test_sums_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_tokens(docs, ["the", "and"])
    total = corpus_total(kept).first()[0]
    assert total > 0
    assert term_counts(kept).agg({"occurrences": "sum"}).first()[0] == total
    assert postings(kept).agg({"occurrences": "sum"}).first()[0] == total
    assert raw_postings(kept).count() == total


def test_ranking_is_a_total_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ranked = rows(rank_terms(term_counts(corpus_tokens(docs))))
    assert ranked == sorted(ranked, key=lambda row: (-row[1], row[0].encode()))


def test_last_per_key_with_two_orders(spark):
    data = spark.createDataFrame(
        [("k", "a", 9, "x"), ("k", "b", 1, "y"), ("k", "b", 0, "z"), ("l", "a", 1, None)],
        "key STRING, file STRING, pos INT, v STRING",
    )
    last = last_per_key(data, ["key"], ["file", "pos"])
    assert sorted(rows(last)) == [("k", "b", 1, "y"), ("l", "a", 1, None)]


def test_plans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = physical_plan(postings(corpus_tokens(docs, ["the"])))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    one_word = physical_plan(postings(corpus_tokens(docs)).where("word = 'le'"))
    assert one_word.index("HashAggregate") < one_word.index("= le)")
    total = physical_plan(corpus_total(corpus_tokens(docs, ["the"])))
    assert "ReadSchema: struct<text:string>" in total
    for text in (plan, one_word, total):
        assert "Python" not in text


def test_plans_at_test_size_are_those_of_any_size(spark):
    """Small inputs are not dealt anew: the plans below are what a large input gets."""
    from catalog import QUERIES

    total = physical_plan(QUERIES["corpus_total_terms"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<text:string>" in total
    assert total.count("Exchange") == 1
    grouped = physical_plan(QUERIES["postings_grouped"](spark, "/root/testdata/sf0.001"))
    assert grouped.count("Exchange hashpartitioning(word") == 1
    by_row = physical_plan(QUERIES["postings"](spark, "/root/testdata/sf0.001"))
    assert "Exchange" not in by_row


def test_repeated_ids_are_summed_row_by_row(spark):
    docs = spark.createDataFrame([(1, "x x"), (1, "x y"), (2, "x")], "doc_id BIGINT, text STRING")
    got = sorted(map(tuple, build_index(docs, unique_ids=True).collect()))
    assert got == [("x", 1, 3), ("x", 2, 1), ("y", 1, 1)]


def test_only_rows_of_repeated_ids_are_grouped(spark, monkeypatch):
    """Null is an id, too. With too many repeated ids for a broadcast all rows are grouped."""
    from wordloom.plans import index

    data = [(1, "x x the"), (1, "x y"), (2, "x z x"), (None, "x"), (None, "y x"), (3, None), (4, " ")]
    docs = spark.createDataFrame(data, "doc_id BIGINT, text STRING")
    want = {("x", 1, 3), ("y", 1, 1), ("x", 2, 2), ("z", 2, 1), ("x", None, 2), ("y", None, 1)}
    grouped = []
    count = index.postings
    monkeypatch.setattr(index, "postings", lambda toks: grouped.append(toks) or count(toks))
    for stop in (["the"], spark.createDataFrame([("the",)], "word STRING")):
        got = [tuple(r) for r in build_index(docs, stop).collect()]
        assert len(got) == len(want) and set(got) == want
        assert {r["doc_id"] for r in grouped[-1].collect()} == {1, None}
    monkeypatch.setattr(index, "fits_broadcast", lambda ids: False)
    assert {tuple(r) for r in build_index(docs, ["the"]).collect()} == want
    assert {r["doc_id"] for r in grouped[-1].collect()} == {1, 2, None}
