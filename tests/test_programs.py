import time
from pathlib import Path

import pytest

from catalog import roundtrips
from tests.plans import physical_plan
from wordloom import schemas
from wordloom.operators import summed_in_order, summed_postings
from wordloom.plans import (
    count_corpus,
    load_tables,
    programs,
    rank_corpus_terms,
    run_queries,
    write_entities,
    write_index,
)
from wordloom.plans.programs import last_lists
from wordloom.scratch import FREE_SHUFFLES, shared_folder
from wordloom.sources import (
    parse_parents,
    parse_postings,
    read_lines,
    read_postings,
    read_rejects,
    read_table,
    reject_counts,
    write_table,
)
from wordloom.sources.readers import accepted

NAMES = ["docs", "stop", "parents", "children", "words"]


def child(entity_id, label, fallback):
    return "\t".join([str(entity_id), *[""] * 7, label, fallback])


TEXTS = [
    '10\tThe cat-dog, the "CAT" runs.\n2\tDog.\n7\t\n\n',
    "the a\nThe\n",
    '10\t\tHeat\t1995\n2\t\tSay "Yo"\t\n7\t\tNone\n',
    "\n".join(
        [
            child(10, "Al P", "30"),
            child(10, "/m/0x", "Bob D"),
            child(2, "Jo S", "40"),
            child(10, "12.5", "Val K"),
        ]
    ),
    "dog\nDog\nrow'; --\nruns\n",
]


@pytest.fixture
def paths(tmp_path):
    for name, text in zip(NAMES, TEXTS):
        (tmp_path / name).write_text(text)
    return lambda name: str(tmp_path / name)


def written(path):
    parts = sorted(Path(path).glob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]


def test_count_corpus(spark, paths):
    count_corpus(spark, paths("docs"), paths("stop"), paths("out"))
    assert written(paths("out")) == ["\t5"]


def test_rank_corpus_terms(spark, paths):
    rank_corpus_terms(spark, paths("docs"), paths("stop"), paths("out"))
    assert written(paths("out")) == ["cat\t2", "dog\t2", "runs\t1"]


def test_index_takes_whole_lines_as_stop_words(spark, paths):
    write_index(spark, paths("docs"), paths("stop"), paths("out"), files=2)
    assert sorted(written(paths("out"))) == [
        "cat 10 2",
        "dog 10 1",
        "dog 2 1",
        "runs 10 1",
        "the 10 2",
    ]


def test_index_without_counting(spark, paths):
    write_index(spark, paths("docs"), paths("stop"), paths("out"), files=0)
    assert sorted(written(paths("out"))).count("cat 10 1") == 2


def test_entities(spark, paths):
    write_entities(spark, paths("parents"), paths("children"), paths("out"), files=1)
    assert written(paths("out")) == ['2\tSay "Yo"\tJo S', "7\tNone\t", "10\tHeat\tAl P\tBob D\tVal K"]
    write_entities(spark, paths("parents"), paths("children"), paths("out"), files=0)
    assert sorted(written(paths("out"))) == ["10\tHeat", '2\tSay "Yo"', "7\tNone"]


@pytest.mark.parametrize("part_length", [None, 2])
@pytest.mark.parametrize("one_per_word", [False, True])
def test_load_and_query(spark, paths, one_per_word, part_length):
    write_index(spark, paths("docs"), paths("stop"), paths("index"), files=1)
    write_entities(spark, paths("parents"), paths("children"), paths("entities"), 2, part_length)
    load_tables(
        spark,
        paths("index"),
        paths("entities"),
        paths("posting-table"),
        paths("entity-table"),
        one_per_word,
        in_parts=part_length is not None,
    )
    posts = read_table(spark, paths("posting-table"), schemas.POSTINGS)
    assert posts.count() == (4 if one_per_word else 5)
    found = run_queries(spark, paths("posting-table"), paths("entity-table"), paths("words"))
    got = {}
    for r in found.collect():
        got.setdefault((r["qid"], r["word"], r["rank"], r["name"]), []).extend(r["children"])
    cast = ["Al P", "Bob D", "Val K"]
    # The last posting of dog is that of id 2: the file is sorted by id as text.
    dogs = {(0, "dog", 1, "Say 'Yo'"): ["Jo S"]}
    if not one_per_word:
        dogs[(0, "dog", 2, "Heat")] = cast
    assert got == {**dogs, (3, "runs", 1, "Heat"): cast}


def test_bad_lines_are_put_aside(spark, paths, tmp_path):
    (tmp_path / "docs").write_text(TEXTS[0] + "x y\n \n11\n")
    (tmp_path / "parents").write_text(TEXTS[2] + "z\t\tName\n")
    (tmp_path / "children").write_text(TEXTS[3] + "\nshort\n")
    names = [paths(n) for n in ("docs", "stop", "parents", "children", "out", "rejects")]
    docs, stop, parents, children, out, rejects = names
    with pytest.raises(Exception, match="too few fields|bad id"):
        write_entities(spark, parents, children, out)
    write_index(spark, docs, stop, out, 1, rejects)
    assert "dog 2 1" in written(out)
    write_entities(spark, parents, children, out, 1, rejects=rejects)
    assert written(out)[-1] == "10\tHeat\tAl P\tBob D\tVal K"
    for _ in range(2):  # a second run leaves the same
        count_corpus(spark, docs, stop, out, rejects)
        assert written(out) == ["\t5"]
        assert sorted(map(tuple, read_rejects(spark, rejects).collect())) == [
            ("children", "too few fields", "short"),
            ("documents", "bad id", "x y"),
            ("parents", "bad id", "z\t\tName"),
        ]
        # Blank lines, and those with an id alone, are no records.
        assert sorted(map(tuple, reject_counts(spark, rejects).collect())) == [
            ("children", 5, 1),
            ("documents", 3, 1),
            ("parents", 4, 1),
        ]


def test_lines_are_read_once_with_rejects(spark, paths, tmp_path):
    """Every line that is parsed raises the counter, in whatever pass it is."""
    parsed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            parsed.add(batch.num_rows)
            yield batch

    lines = "\n".join(f"{i}\t\tName {i}" if i % 4 else f"x{i}" for i in range(100))
    (tmp_path / "lines").write_text(lines)
    rows = read_lines(spark, paths("lines")).mapInArrow(counted, "file string, pos bigint, value string")
    good = accepted(parse_parents(rows), paths("rejects"), "parents")
    assert good.count() == 75 and good.select("name").distinct().count() == 75
    assert read_rejects(spark, paths("rejects")).count() == 25
    assert parsed.value == 100


def test_programs_leave_nothing_in_the_shared_folder(spark, paths):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    write_index(spark, paths("docs"), paths("stop"), paths("index"), 2, paths("rejects"))
    write_entities(spark, paths("parents"), paths("children"), paths("ents"), 2, 2, paths("rejects"))
    load_tables(
        spark, paths("index"), paths("ents"), paths("posts"), paths("named"), in_parts=True,
        rejects=paths("rejects"),
    )
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_tables(spark, paths("index"), paths("none"), paths("posts"), paths("named"))
    assert {p.name for p in folder.iterdir()} == before


def test_raw_postings_load_as_counts(spark, paths, tmp_path):
    (tmp_path / "docs").write_text("1 x x x y\n")
    index, entities, posts, named = (paths(n) for n in ("index", "ents", "posts", "named"))
    write_index(spark, paths("docs"), paths("stop"), index, files=0)
    write_entities(spark, paths("parents"), paths("children"), entities)
    load_tables(spark, index, entities, posts, named, with_id=True, text="compat", files=1)
    got = sorted(map(tuple, spark.read.parquet(posts).collect()))
    assert got == [("x", 1, 3, "x1"), ("y", 1, 1, "y1")]
    texts = {r["entity_id"]: r["children_text"] for r in spark.read.parquet(named).collect()}
    assert texts == {10: "Al P Bob DVal K ", 2: "Jo S ", 7: ""}


def test_entity_lines_are_read_once(spark, tmp_path):
    """The last pieces are read three times, the lines once."""
    read = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    data = [(1, "a", 0, 3, ["x", "y"], "f", 0), (1, "a", 1, 3, ["z"], "f", 1), (1, "b", 0, 1, ["w"], "g", 0)]
    schema = f"{schemas.ENTITIES}, file STRING, pos BIGINT"
    df = spark.createDataFrame(data, schema)
    got = last_lists(df.mapInArrow(pass_on, df.schema))
    assert [tuple(r) for r in got.collect()] == [(1, "b", 0, 1, ["w"])]
    assert read.value == 3


def test_sums_meet_in_the_ranges_of_the_table(spark, tmp_path, monkeypatch):
    """One exchange, for the ranges, in which rows are sorted once and summed in their order."""
    data = [(w, d, n) for w in ("x", "y", None) for d in (1, 2, None) for n in (1, 4)]
    posts = spark.createDataFrame(data, schemas.POSTINGS)
    seen = []

    def combine(ranged):
        rows = summed_in_order(ranged)
        seen.append(physical_plan(rows.sortWithinPartitions("word", "doc_id")))
        return rows

    write_table(posts, str(tmp_path / "t"), ["word", "doc_id"], 3, combine=combine)
    assert "HashAggregate" not in seen[0]
    assert seen[0].count("Exchange") == seen[0].count("Exchange rangepartitioning") == 1
    assert seen[0].count("+- Sort [") == 1
    got = [tuple(r) for r in read_table(spark, str(tmp_path / "t"), schemas.POSTINGS).collect()]
    assert len(got) == 9 and {r[2] for r in got} == {5}
    assert set(got) == {tuple(r) for r in summed_postings(posts).collect()}


@pytest.mark.parametrize("with_rejects", [False, True])
def test_lines_of_one_id_are_summed_in_the_index(spark, paths, tmp_path, with_rejects):
    (tmp_path / "docs").write_text("1 x x y\n2 x\n1 y z\n" * 3)
    rejects = paths("rejects") if with_rejects else None
    for files in (2, None):
        write_index(spark, paths("docs"), paths("stop"), paths("out"), files, rejects)
        assert sorted(written(paths("out"))) == ["x 1 6", "x 2 3", "y 1 6", "z 1 3"]


def test_staged_lines_are_not_sorted(spark, paths, tmp_path):
    """Good and bad lines are staged in the order they come in, as one table."""
    (tmp_path / "lines").write_text("a 1 2\nx\nb 2 2\n")
    parsed = parse_postings(spark.read.text(paths("lines")))
    good = accepted(parsed, paths("rejects"), "postings")
    assert "problem=" not in "".join(good.inputFiles())
    assert "PartitionFilters: []" in physical_plan(good)
    assert not any("problem=" in str(p) for p in Path(shared_folder(spark).removeprefix("file:")).glob("parsed-*/*"))
    assert sorted(map(tuple, good.collect())) == [("a", 1, 2), ("b", 2, 2)]


def test_a_strict_reader_splits_a_line_once(spark, tmp_path):
    (tmp_path / "part-0").write_text("a 1 2\nb 2 3\n")
    posts = read_postings(spark, str(tmp_path), placed=False)
    assert physical_plan(posts).count("split(") == 1
    assert sorted(map(tuple, posts.collect())) == [("a", 1, 2), ("b", 2, 3)]
    (tmp_path / "part-1").write_text("b x 3\n")
    with pytest.raises(Exception, match="bad id: b x 3"):
        read_postings(spark, str(tmp_path), placed=False).count()


def names_in(folder):
    """What lies in the shared folder, without the ids of its names."""
    return sorted(p.name.rpartition("-")[0] for p in folder.iterdir())


def test_programs_keep_no_step_longer_than_it_is_read(spark, paths, monkeypatch):
    """Parsed lines go once they are counted, and rows that are staged are not staged again."""
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before, seen = names_in(folder), []

    def summed(rows):
        seen.append(names_in(folder))
        return summed_in_order(rows)

    monkeypatch.setattr(programs, "summed_in_order", summed)
    write_index(spark, paths("docs"), paths("stop"), paths("index"), 2, paths("rejects"))
    write_entities(spark, paths("parents"), paths("children"), paths("ents"), 2)
    load_tables(
        spark, paths("index"), paths("ents"), paths("posts"), paths("named"), rejects=paths("rejects")
    )
    for names in before:
        for step in seen:
            step.remove(names)
    assert seen == [["counted"], ["parsed"]]
    posts = read_table(spark, paths("posts"), schemas.POSTINGS)
    assert sorted(map(tuple, posts.collect()))[:2] == [("cat", 10, 2), ("dog", 2, 1)]


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def shuffled():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {name for name in blocks.getAllFiles().mkString(" ").split() if "/shuffle_" in name}

    posts = spark.range(10_000).selectExpr("uuid() AS word", "id AS doc_id", "id AS occurrences")
    before = shuffled()
    write_table(posts, str(tmp_path / "t"), ["word", "doc_id"], 3)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    assert read_table(spark, str(tmp_path / "t"), schemas.POSTINGS).count() == 10_000


def test_compressed_text_loads_like_plain(spark, paths):
    found = []
    for codec in (None, "gzip"):
        index, entities = paths(f"index-{codec}"), paths(f"ents-{codec}")
        write_index(spark, paths("docs"), paths("stop"), index, 2, compression=codec)
        write_entities(spark, paths("parents"), paths("children"), entities, 2, compression=codec)
        parts = [*Path(index).glob("part-*"), *Path(entities).glob("part-*")]
        assert parts and all((p.suffix == ".gz") == (codec == "gzip") for p in parts)
        posts, named = paths(f"posts-{codec}"), paths(f"named-{codec}")
        load_tables(spark, index, entities, posts, named)
        tables = [read_table(spark, posts, schemas.POSTINGS), read_table(spark, named, schemas.ENTITIES)]
        found.append([sorted(map(str, rows.collect())) for rows in tables])
    assert found[0] == found[1] and len(found[0][0]) == 5


def test_rejected_lines_leave_only_what_is_read(spark, tmp_path, monkeypatch):
    """Two whole runs on one set of files; what the first wrote is gone before the second writes."""
    docs = [(i, f"word{i % 7} and\nrow {i}", "en", "web", 9) for i in range(150)]
    columns = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(docs, columns).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 2)], "doc_id BIGINT, quality INT, toxic INT")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before, loaded = {p.name for p in folder.iterdir()}, []

    def load(spark, index, entities, posts, named, **options):
        load_tables(spark, index, entities, posts, named, **options)
        new = sorted(p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before)
        counts = [read_table(spark, posts, schemas.POSTINGS).count(), read_table(spark, named, schemas.ENTITIES).count()]
        loaded.append((new, counts))

    monkeypatch.setattr(roundtrips, "load_tables", load)
    found = roundtrips.programs_rejected_lines(spark, str(tmp_path))
    run = ["entities", "entity-table", "index", *["lines"] * 5, "postings", "rejects"]
    assert loaded == [(run, [450, 150])] * 2
    assert [p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before] == ["rejects"]
    no_id, short = [0, 50, 100, 0, 50, 100], [70, 140, 70, 140]
    lines = [("documents", "bad id", f"x{i}\tno number") for i in no_id]
    for kind in ("parents", "children"):
        lines += [(kind, "too few fields", f"x{i}\tno number") for i in no_id]
        lines += [(kind, "too few fields", f"y{i}") for i in short]
    assert sorted(map(tuple, found.collect())) == sorted(lines)
