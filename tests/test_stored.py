import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from wordloom.operators import (
    code_blocks,
    decode_blocks,
    filter_by_bitmaps,
    heavy_keys,
    last_posting_per_word,
    match_words,
    numbered_postings,
    parent_child_list,
    postings_between,
    postings_from,
    split_join,
    term_dictionary,
    word_set,
)
from wordloom.operators import dictionary
from wordloom.operators.bitmaps import with_maybe
from wordloom.operators.index import text_order
from wordloom.plans import (
    create_updatable,
    follow_entities,
    follow_postings,
    top_by_impact,
    update_tables,
    write_impact_index,
)
from wordloom.scratch import shared_folder
from wordloom.sources import create_ranged, read_ranged, upsert, write_bucketed, writers

POSTS = "word string, doc_id bigint, occurrences bigint"
LISTS = "entity_id bigint, name string, part bigint, n_children bigint, children array<string>"


@pytest.fixture
def no_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def postings_rows(seed=1, words=6, docs=300):
    rng = random.Random(seed)
    rows = []
    for w in range(words):
        some = rng.sample(range(docs), docs if w == 0 else rng.randint(1, docs // (w + 1)))
        rows += [(f"w{w}", d, rng.choice([1, 1, 1, 2, 2, 3, 9])) for d in some]
    return rows


def best(rows, ids, word, k):
    hits = sorted((-n, d) for w, d, n in rows if w == word and d in ids)[:k]
    return [(word, d, -n, rank + 1) for rank, (n, d) in enumerate(hits)]


# Impact order


@pytest.mark.parametrize("every,block", [(1, 4), (1, 64), (7, 4), (50, 8), (1000, 4)])
def test_top_by_impact_equals_sorting_all(spark, tmp_path, every, block):
    rows = postings_rows()
    index = write_impact_index(spark.createDataFrame(rows, POSTS), str(tmp_path / "i"), block)
    ids = spark.range(0, 300, every).select(F.col("id").alias("entity_id"))
    words = word_set(ids, ["w0", "w1", "w5", "none", "w0"])
    top, read = top_by_impact(spark, index, ids, words, k=5)
    kept = set(range(0, 300, every))
    want = [r for w in ("w0", "w1", "w5") for r in best(rows, kept, w, 5)]
    assert rows_of(top) == sorted(want, key=repr)
    assert read[0] == 3 and read == sorted(read, reverse=True)


def test_blocks_read_follow_the_answer_and_not_the_list(spark, tmp_path):
    for docs in (200, 2_000):
        rows = [("the", d, d % 5) for d in range(docs)]
        index = write_impact_index(spark.createDataFrame(rows, POSTS), str(tmp_path / str(docs)), 16)
        ids = spark.range(docs).select(F.col("id").alias("entity_id"))
        top, read = top_by_impact(spark, index, ids, word_set(ids, ["the"]), k=10)
        assert read == [1]  # the first block only
        assert [r["doc_id"] for r in top.orderBy("rank").collect()] == list(range(4, 54, 5))
    first = index.read_postings(spark).where("tier = 0")
    assert "PartitionFilters: [isnotnull(tier" in physical_plan(first) and first.count() == 16
    blocks = rows_of(index.read_blocks(spark))
    assert [b[2] for b in blocks] == [16] * 125 and sum(b[1] == 0 for b in blocks) == 1
    tiers = Counter(r["tier"] for r in index.read_postings(spark).select("tier", "block").distinct().collect())
    assert tiers == {0: 1, 1: 2, 2: 4, 3: 8, 4: 16, 5: 32, 6: 62}


def test_impact_index_of_nothing(spark, tmp_path):
    index = write_impact_index(spark.createDataFrame([], POSTS), str(tmp_path / "i"))
    ids = spark.range(3).select(F.col("id").alias("entity_id"))
    top, read = top_by_impact(spark, index, ids, word_set(ids, ["a"]))
    assert top.count() == 0 and read == []


# Upsert


def lists(rows):
    """(id, list) pairs in parts of two, as rows of entities."""
    out = []
    for i, labels in rows:
        parts = [labels[a : a + 2] for a in range(0, len(labels), 2)] or [[]]
        out += [(i, f"n{i}", p, len(labels), part) for p, part in enumerate(parts)]
    return out


def files(path):
    return {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet") if "_bounds" not in str(p)}


def test_upsert_replaces_whole_lists_and_leaves_other_files(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(i, ["a", "b", "c", "d", "e"]) for i in range(100)]
    create_ranged(spark.createDataFrame(lists(old), LISTS), path, ["entity_id", "part"], ranges=10)
    before = files(path)
    assert len({p.parent for p in before}) == 10
    changed = [(3, ["x"]), (4, []), (98, ["y", "z", "y"]), (500, ["new"])]
    gone = spark.createDataFrame([(5,), (77,), (12345,)], "entity_id int")
    assert upsert(spark.createDataFrame(lists(changed), LISTS), path, gone) == 2
    after = files(path)
    untouched = {p for p in before if p in after and before[p] == after[p]}
    assert len({p.parent for p in untouched}) == 7  # of ten ranges, those of 3 to 5, 77 and 98 changed
    want = {i: v for i, v in old if i not in (5, 77)} | dict(changed)
    got = read_ranged(spark, path)
    new = {3, 4, 98, 500}
    assert rows_of(got) == sorted(((*r, 2 if r[0] in new else 1) for r in lists(want.items())), key=repr)
    assert {r["entity_id"] for r in read_ranged(spark, path, since=1).collect()} == new


def test_tasks_of_a_growing_table_stay_small(spark, tmp_path, monkeypatch):
    """Bounds stay as they were drawn, but a range that grows is written by several tasks."""
    monkeypatch.setattr(sys.modules["wordloom.sources.upsert"], "RANGE_ROWS", 100)
    path = str(tmp_path / "t")
    for step in range(3):
        rows = [(i, f"n{i}", 0, 0, []) for i in range(step, 900, 3)]
        df = spark.createDataFrame(rows, LISTS)
        create_ranged(df, path, ["entity_id", "part"]) if step == 0 else upsert(df, path)
    sizes = [spark.read.parquet(str(p)).count() for p in files(path)]
    assert sum(sizes) == 900 and max(sizes) <= 200
    assert [r[0] for r in rows_of(read_ranged(spark, path).select("entity_id").orderBy("entity_id"))] == sorted(range(900), key=lambda i: repr((i,)))


def test_upsert_of_null_keys_emptied_ranges_and_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(None, "a"), (None, "b"), (1, "c"), (2, "d"), (3, "e")]
    create_ranged(spark.createDataFrame(rows, "k int, v string"), path, ["k"], ranges=3)
    none = spark.createDataFrame([], "k int, v string")
    assert upsert(none, path) == 1
    assert upsert(spark.createDataFrame([(None, "n")], "k int, v string"), path) == 2
    assert rows_of(read_ranged(spark, path).drop("generation")) == [(1, "c"), (2, "d"), (3, "e"), (None, "n")]
    everything = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    upsert(none, path, everything)
    assert rows_of(read_ranged(spark, path).drop("generation")) == [(None, "n")]
    with pytest.raises(TypeError):
        create_ranged(none, path, ["v"])


def test_a_failed_upsert_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    create_ranged(spark.range(10).withColumn("v", F.lit("x")), path, ["id"], ranges=2)
    before = files(path)
    bad = spark.range(3).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        upsert(bad, path)
    assert files(path) == before


def test_tables_follow_their_text(spark, tmp_path):
    def part(folder, name, text):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)
        return str(tmp_path / folder)

    posts, named = str(tmp_path / "posts"), str(tmp_path / "named")
    index = part("index", "part-1", "a 1 2\nb 1 1\na 2 1\n")
    entities = part("ents", "part-1", "1\tOne\tx\ty\n2\tTwo\n")
    create_updatable(spark, index, entities, posts, named, ranges=2)
    update_tables(
        spark, posts, named,
        part("index2", "part-1", "c 2 1\nc 2 1\n"),
        part("ents2", "part-1", '2\tTwo "2"\tz\n'),
        gone=spark.createDataFrame([(1,)], "id bigint"),
    )
    assert rows_of(read_ranged(spark, posts)) == [("c", 2, 2, 2)]
    assert rows_of(read_ranged(spark, named)) == [(2, "Two '2'", 0, 1, ["z"], 2)]


def test_only_new_part_files_are_read(spark, tmp_path):
    folder, state, path = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "t")
    folder.mkdir()
    (folder / "part-1").write_text("1\tOne\ta\tb\tc\n2\tTwo\n")
    (folder / "other").write_text("9\tNine\n")
    follow_entities(spark, str(folder), path, state)
    before = files(path)
    follow_entities(spark, str(folder), path, state)
    assert files(path) == before
    (folder / "part-2").write_text("1\tUno\td\n3\tThree\n")
    (folder / "part-3").write_text("3\tTres\n")
    follow_entities(spark, str(folder), path, state)
    got = rows_of(read_ranged(spark, path).select("entity_id", "name", "children", "generation"))
    assert got == [(1, "Uno", ["d"], 2), (2, "Two", [], 1), (3, "Tres", [], 2)]


def test_postings_of_growing_folders(spark, tmp_path):
    folder, state, path = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "t")
    folder.mkdir()
    (folder / "part-1").write_text("a 1 1\nb 1 2\na 2 1\n")
    follow_postings(spark, str(folder), path, state)
    (folder / "part-2").write_text("c 2 3\nc 3 1\n")
    follow_postings(spark, str(folder), path, state)
    assert rows_of(read_ranged(spark, path).select("word", "doc_id", "occurrences")) == [
        ("a", 1, 1), ("b", 1, 2), ("c", 2, 3), ("c", 3, 1),
    ]


# Buckets


def test_bucketed_tables_join_and_group_without_an_exchange(spark, tmp_path, no_broadcast):
    posts = spark.createDataFrame(postings_rows(), POSTS)
    parents = spark.range(300).select(F.col("id").alias("entity_id"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").alias("pos"))
    children = spark.range(900).select((F.col("id") % 300).alias("entity_id"), F.col("id").cast("string").alias("label"), F.col("id").alias("pos"))
    write_bucketed(posts, "bucket_posts", "doc_id", 4, ["word"], str(tmp_path / "p"))
    write_bucketed(parents, "bucket_parents", "entity_id", 4, (), str(tmp_path / "e"))
    write_bucketed(children, "bucket_children", "entity_id", 4, ["pos"], str(tmp_path / "c"))
    try:
        assert len(list((tmp_path / "p").glob("part-*"))) == 4
        ids = spark.table("bucket_parents").select("entity_id").hint("merge")
        met = match_words(spark.table("bucket_posts").where(F.col("word").isin(["w0"])), ids)
        assert "Exchange" not in physical_plan(met) and "SortMergeJoin" in physical_plan(met)
        assert met.count() == 300
        found = parent_child_list(spark.table("bucket_parents"), spark.table("bucket_children"))
        assert "Exchange" not in physical_plan(found)
        assert rows_of(found) == rows_of(parent_child_list(parents, children))
    finally:
        for name in ("posts", "parents", "children"):
            spark.sql(f"DROP TABLE bucket_{name}")


def test_buckets_have_several_files_where_a_task_would_sort_too_many_rows(
    spark, tmp_path, monkeypatch, no_broadcast
):
    monkeypatch.setattr(writers, "FILE_ROWS", 50)
    rows = [(f"w{i % 5}", None if i % 97 == 0 else i, 1) for i in range(1_000)]
    write_bucketed(spark.createDataFrame(rows, POSTS), "split_posts", "doc_id", 4, ["word"], str(tmp_path / "p"))
    try:
        parts = list((tmp_path / "p").glob("part-*"))
        assert len(parts) == 20
        sizes = [spark.read.parquet(str(p)).count() for p in parts]
        assert max(sizes) <= 100
        table = spark.table("split_posts")
        assert rows_of(table) == sorted(rows, key=repr)
        grouped = table.groupBy("doc_id").count()
        assert "Exchange" not in physical_plan(grouped)
        assert rows_of(grouped.where("doc_id IS NOT NULL")) == sorted(((r[1], 1) for r in rows if r[1] is not None), key=repr)
    finally:
        spark.sql("DROP TABLE split_posts")


# Bitmaps


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_bitmaps_are_exact(spark, how):
    words = spark.range(0, 3000, 2).select(F.concat(F.lit("w"), "id").alias("word"))
    rows = spark.range(20_000).select(
        (F.col("id") % 50).alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 5000).alias("word")
    )
    rows = rows.unionByName(spark.createDataFrame([(1, None)], "doc_id bigint, word string"))
    got = filter_by_bitmaps(rows, words, 1500, how)
    assert rows_of(got) == rows_of(rows.join(words, "word", how).select("doc_id", "word"))
    # Rows do not move: only bitmaps and words that are in doubt and wrong are broadcast.
    plan = physical_plan(got)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    with pytest.raises(ValueError):
        filter_by_bitmaps(rows, words, 1500, "inner")


def test_bitmaps_leave_few_in_doubt(spark):
    words = spark.range(50_000).select(F.concat(F.lit("in"), "id").alias("word"))
    others = spark.range(50_000).select(F.concat(F.lit("out"), "id").alias("word"))
    assert with_maybe(words, words, 50_000).where("NOT _maybe").count() == 0
    assert with_maybe(others, words, 50_000).where("_maybe").count() < 1_000


# Heavy keys


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_heavy_keys_are_split(spark, how):
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 999))
        left = spark.range(30_000).select("id", key.alias("key"))
        left = left.unionByName(spark.createDataFrame([(-1, None)], "id bigint, key string"))
        right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("k2", 4)], "key string, v int")
        heavy = heavy_keys(left, "key")
        assert heavy == ["hot"]
        joined = split_join(left, right.hint("merge"), "key", how, ["id"], heavy)
        assert rows_of(joined) == rows_of(left.join(right, "key", how).select(joined.columns))
        if how in ("inner", "left"):
            sizes = Counter(r[0] for r in joined.where("key = 'hot'").select(F.spark_partition_id()).collect())
            assert len(sizes) > 3 and max(sizes.values()) < 5_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_even_keys_are_left_alone(spark):
    left = spark.range(1000).select(F.col("id").alias("key"))
    assert heavy_keys(left, "key") == []
    assert "_salt" not in physical_plan(split_join(left, left, "key", "inner", ["key"], []))
    assert heavy_keys(left.limit(0), "key") == []


# Term ids and coded blocks


def test_terms_are_numbered_in_order(spark):
    words = [f"w{i % 700}" for i in range(2000)] + ["", "é", "Z", None]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    want = sorted(set(words) - {None}, key=str.encode)
    assert rows_of(term_dictionary(rows)) == sorted(enumerate(want), key=repr)
    assert term_dictionary(rows.limit(0)).count() == 0


def test_postings_with_term_ids_are_in_word_order(spark):
    rows = postings_rows()
    posts = spark.createDataFrame(rows + rows[:50], POSTS)
    numbers = numbered_postings(posts, term_dictionary(posts))
    want = Counter()
    for w, d, n in rows + rows[:50]:
        want[w, d] += n
    got = [tuple(r) for r in numbers.collect()]
    assert got == [(int(w[1:]), d, n) for (w, d), n in sorted(want.items())]


@pytest.mark.parametrize("block", [1, 7, 128])
def test_blocks_decode_to_the_postings(spark, block):
    rows = postings_rows(docs=200)
    blocks = code_blocks(spark.createDataFrame(rows, POSTS), block)
    assert rows_of(decode_blocks(blocks)) == sorted(rows, key=repr)
    for r in blocks.collect():
        docs = [r["min_doc"] + g for g in r["gaps"]]
        assert docs == sorted(docs) and docs[-1] == r["max_doc"] and len(docs) == r["n"] <= block
        assert r["max_occurrences"] == max(r["counts"])
    got = postings_between(blocks, "w0", 20, 40)
    assert rows_of(got) == sorted((r for r in rows if r[0] == "w0" and 20 <= r[1] <= 40), key=repr)
    got = postings_from(blocks, "w1", 3)
    assert rows_of(got) == sorted((r for r in rows if r[0] == "w1" and r[2] >= 3), key=repr)


# Text order


def counted(spark, df):
    """The rows, and an accumulator of how many were read."""
    read = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(pass_on, df.schema), read


def test_blocks_run_their_source_once(spark, tmp_path):
    """It is not run again for a sample of the ranges; what is staged goes."""
    rows = postings_rows()
    source, read = counted(spark, spark.createDataFrame(rows, POSTS))
    assert rows_of(decode_blocks(code_blocks(source))) == sorted(rows, key=repr)
    assert read.value == len(rows)
    source, read = counted(spark, spark.createDataFrame(rows, POSTS))
    write_impact_index(source, str(tmp_path / "i"), 4)
    assert read.value == len(rows)
    assert not list(Path(shared_folder(spark).removeprefix("file:")).glob("unplaced-*"))


def test_only_heavy_words_are_repeated_for_their_numbers(spark, monkeypatch, no_broadcast):
    """A dictionary too long for a broadcast is joined as it is, but for heavy words."""
    monkeypatch.setattr(dictionary, "fits_broadcast", lambda df: False)
    rows = [("all", d, 2) for d in range(12_000)] + [(f"w{d}", d, 1) for d in range(300)]
    posts = spark.createDataFrame(rows, POSTS)
    terms = term_dictionary(posts)
    joined = dictionary.by_term_id(posts, terms)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "IN (all)" in plan or "= all" in plan
    ids = {r["word"]: r["term_id"] for r in terms.collect()}
    assert rows_of(joined) == sorted(((ids[w], d, n) for w, d, n in rows), key=repr)


def test_numbers_in_the_order_of_their_texts(spark):
    rng = random.Random(2)
    some = [rng.randrange(10 ** rng.randint(1, 18)) for _ in range(400)]
    some += [-n for n in some[:150]] + [0, 1, 10, 100, 2**63 - 1, -(2**63), 10**17, 10**17 - 1, 10**18]
    some = sorted(set(some), key=str)
    posts = [(f"{a} {b}", n, i) for a, x in enumerate(some) for b, y in [(a, some[a * 7 % len(some)])] for i, n in ((1, x), (2, y)) if i == 1 or y != x]
    got = last_posting_per_word(spark.createDataFrame(posts, POSTS))
    want = {}
    for w, d, n in posts:
        if w not in want or str(d) > str(want[w][0]):
            want[w] = (d, n)
    assert {r["word"]: (r["doc_id"], r["occurrences"]) for r in got.collect()} == want
    plan = physical_plan(got)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    packed, wide = text_order(F.col("n"))
    rows = spark.createDataFrame([(n,) for n in some], "n bigint").select("n", packed.alias("p"), wide.alias("w"))
    small = [r for r in rows.collect() if r["p"] is not None]
    assert [r["n"] for r in sorted(small, key=lambda r: r["p"])] == sorted((r["n"] for r in small), key=str)
    large = [r for r in rows.collect() if r["w"] is not None]
    assert [r["n"] for r in sorted(large, key=lambda r: r["w"])] == sorted((r["n"] for r in large), key=str)


def test_null_ids_are_last_only_among_themselves(spark):
    posts = spark.createDataFrame([("a", None, 5), ("b", None, 1), ("b", -7, 2), ("c", 3, 4), ("c", None, 9)], POSTS)
    assert rows_of(last_posting_per_word(posts)) == [("a", None, 5), ("b", -7, 2), ("c", 3, 4)]
