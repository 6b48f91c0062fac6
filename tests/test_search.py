import re

import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from wordloom import schemas
from wordloom.operators import (
    best_of_word,
    keep_query_words,
    parent_child_list,
    search,
    top_per_key,
    top_postings,
)
from wordloom.plans import build_entities, build_index, search_documents, search_tables
from wordloom.sources import query_words, write_table

PARENTS = [(10, "Heat", 0), (2, 'Say "Yo"', 1), (7, "None", 2)]
CHILDREN = [(10, "Al P", 0), (2, "Jo S", 2), (10, "Val K", 3)]
DOCS = [(10, 'The cat-dog, the "CAT" runs. Don\'t 007'), (2, "Dog."), (7, ""), (5, "dog dog 7")]


@pytest.fixture(scope="module")
def frames(spark):
    return (
        spark.createDataFrame(DOCS, schemas.DOCUMENTS),
        spark.createDataFrame(PARENTS, schemas.PARENTS),
        spark.createDataFrame(CHILDREN, schemas.CHILDREN),
    )


def answers(df):
    return [(r["qid"], r["word"], r["rank"], r["name"], r["children"]) for r in df.collect()]


def test_fixture(spark, frames):
    words = query_words(spark, ["dog", "Dog", "", "don't", "dog", "007", "7", " dog"])
    got = answers(search_documents(*frames, words, ["the"]))
    dogs = [("dog", 1, 'Say "Yo"', ["Jo S"]), ("dog", 2, "Heat", ["Al P", "Val K"])]
    assert got == [
        *[(0, *dog) for dog in dogs],
        (3, "don't", 1, "Heat", ["Al P", "Val K"]),
        *[(4, *dog) for dog in dogs],
        (5, "007", 1, "Heat", ["Al P", "Val K"]),
    ]


def test_many_words(spark, frames, monkeypatch):
    """The same answers where nothing may be broadcast for the words' sake."""
    words = query_words(spark, ["dog", "cat", "dog", "none"])
    want = answers(search_documents(*frames, words))
    monkeypatch.setattr("wordloom.plans.search.few_ids", lambda *_: None)
    found = search_documents(*frames, words, few=False)
    plan = physical_plan(found)
    assert "_salt" in plan  # ids of parents and children, which are narrow
    # Lists are made after that: no row with a list is copied.
    assert not re.search(r"Generate explode[^\n]*children", plan)
    assert answers(found) == want


def test_few_jobs_before_the_answer(spark, frames):
    """The words are measured once, and the winners kept once."""
    words = query_words(spark, ["dog", "cat"])
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "search")
    search_documents(*frames, words)
    jobs = context.statusTracker().getJobIdsForGroup("few-jobs")
    context.setJobGroup("", "")
    # Each shuffle of an adaptive plan is a job of its own.
    assert len(jobs) <= 10


def test_no_words(spark, frames):
    assert search_documents(*frames, query_words(spark, ["x"]).where("false")).count() == 0


def brute_force(posts, ids, words, k):
    rows = []
    for qid, word in words:
        hits = [p for p in posts if p[0] == word and p[1] in ids]
        for rank, (_, doc_id, n) in enumerate(sorted(hits, key=lambda p: (-p[2], p[1]))[:k], 1):
            rows.append((qid, word, rank, doc_id, n))
    return rows


@pytest.fixture(scope="module")
def hot_word(spark):
    """Word w0 has a third of the postings, and ties everywhere."""
    posts = [("w0", d, d % 3 + 1) for d in range(2_000)]
    posts += [(f"w{w}", d, d % 5 + 1) for w in range(1, 401) for d in range(w, w + 10)]
    ids = [d for d in range(2_000) if d % 4]
    entities = spark.createDataFrame(
        [(d, f"n{d}", 0, 0, []) for d in ids], schemas.ENTITIES
    )
    return posts, set(ids), spark.createDataFrame(posts, schemas.POSTINGS), entities


@pytest.mark.parametrize("k", [1, 10, 37])
def test_hot_word(spark, hot_word, k):
    posts, ids, post_df, entities = hot_word
    words = [(0, "w0"), (1, "w3"), (2, "none"), (3, "w0")]
    found = search_tables(post_df, entities, spark.createDataFrame(words, schemas.QUERY_WORDS), k)
    columns = ("qid", "word", "rank", "doc_id", "occurrences")
    assert [tuple(r[c] for c in columns) for r in found.collect()] == brute_force(
        posts, ids, words, k
    )


def test_hot_query_word_beyond_broadcast(spark, hot_word, monkeypatch):
    """Neither the words nor the winners may be broadcast, and one word repeats."""
    posts, ids, post_df, entities = hot_word
    monkeypatch.setattr("wordloom.operators.words.LITERAL_WORDS", 3)
    words = [(i, "w0" if i % 3 == 0 else f"w{i}") for i in range(300)]
    query = spark.createDataFrame(words, schemas.QUERY_WORDS)
    wanted = keep_query_words(post_df, query, broadcast_rows=5)
    assert "getbit" in physical_plan(wanted) or "bit_get" in physical_plan(wanted)
    top = top_postings(wanted, entities.select("entity_id"), 4)
    found = search(top, entities, query, few=False)
    columns = ("qid", "word", "rank", "doc_id", "occurrences")
    assert [tuple(r[c] for c in columns) for r in found.collect()] == brute_force(
        posts, ids, words, 4
    )


def test_a_hot_key_is_cut_per_salt(spark, hot_word):
    posts, _, post_df, _ = hot_word
    order = [F.desc("occurrences"), F.asc("doc_id")]
    top = top_per_key(post_df, "word", order, 8, ["doc_id"])
    assert "_salt" in physical_plan(top)
    columns = ("word", "rank", "doc_id", "occurrences")
    got = sorted(tuple(r[c] for c in columns) for r in top.collect())
    words = [(w, w) for w in {p[0] for p in posts}]
    want = brute_force(posts, {p[1] for p in posts}, words, 8)
    assert got == sorted(row[1:] for row in want)


def test_winners_reach_the_scan_of_entities(spark, tmp_path, hot_word):
    _, _, post_df, entities = hot_word
    write_table(entities, str(tmp_path / "entities"), ["entity_id", "part"])
    stored = spark.read.schema(schemas.ENTITIES).parquet(str(tmp_path / "entities"))
    found = search_tables(post_df, stored, query_words(spark, ["w3"]))
    assert re.search(r"PushedFilters: \[[^\]]*In\(entity_id", physical_plan(found))


def test_ties_at_the_cut(spark, hot_word):
    _, _, post_df, entities = hot_word
    best = best_of_word(post_df, entities.select("entity_id"), "w0").collect()
    assert [r["doc_id"] for r in best] == [2, 5, 11, 14, 17, 23, 26, 29, 35, 38]
    assert {r["occurrences"] for r in best} == {3}


def test_lists_in_parts(spark, frames):
    docs, parents, children = frames
    words = query_words(spark, ["cat"])
    parts = search_documents(docs, parents, children, words, part_length=1).collect()
    assert [(r["part"], r["n_children"], r["children"]) for r in parts] == [
        (0, 2, ["Al P"]),
        (1, 2, ["Val K"]),
    ]


def test_top_counts_entities_not_parts(spark, frames):
    _, parents, children = frames
    entities = parent_child_list(parents, children, part_length=1)
    posts = spark.createDataFrame([("x", 10, 5), ("x", 2, 4)], schemas.POSTINGS)
    found = search_tables(posts, entities, query_words(spark, ["x"]), 2).collect()
    assert [(r["rank"], r["doc_id"], r["part"]) for r in found] == [(1, 10, 0), (1, 10, 1), (2, 2, 0)]


def test_plans(spark, tmp_path, hot_word):
    _, _, post_df, entities = hot_word
    path = str(tmp_path / "posts")
    post_df.write.parquet(path)
    stored = spark.read.parquet(path)
    ids = entities.select("entity_id")
    plan = physical_plan(top_postings(keep_query_words(stored, ["w0", "w3"]), ids))
    assert plan.count("WindowGroupLimit") == 4
    assert "PushedFilters: [In(word, [w0,w3])" in plan
    one = physical_plan(best_of_word(stored, ids, "w0"))
    assert "TakeOrderedAndProject" in one
    assert "EqualTo(word,w0)" in one
    for text in (plan, one):
        assert "Python" not in text


def test_stop_words_and_entities_agree_with_tables(spark, frames):
    docs, parents, children = frames
    words = query_words(spark, ["dog", "cat", "the"])
    posts, entities = build_index(docs, ["the"]), build_entities(parents, children)
    direct = answers(search_documents(docs, parents, children, words, ["the"]))
    stored = answers(search_tables(posts, entities, words))
    assert [r[:3] for r in direct] == [r[:3] for r in stored]
    assert all(row[1] != "the" for row in direct)


def test_documents_in_most_answers_are_split(spark, hot_word):
    """Rows of heavy words and documents are dealt over salts, and the order of answers stays."""
    posts, ids, post_df, entities = hot_word
    words = [(i, "w0" if i % 3 else "w7") for i in range(400)]
    query = spark.createDataFrame(words, schemas.QUERY_WORDS)
    top = top_postings(post_df, entities.select("entity_id"), 3)
    found = search(top, entities.hint("merge"), query, few=False, heavy_rows=100)
    assert "_salt" in physical_plan(found)
    columns = ("qid", "word", "rank", "doc_id", "occurrences")
    got = [tuple(r[c] for c in columns) for r in found.collect()]
    assert got == brute_force(posts, ids, words, 3)
