from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wordloom import schemas, scratch
from wordloom.operators import parent_child_list
from wordloom.sources import (
    parse_children,
    parse_documents,
    parse_entities,
    parse_parents,
    parse_postings,
    query_words,
    read_children,
    read_entities,
    read_lines,
    read_parents,
    read_postings,
    read_query_words,
    read_stop_words,
    read_table,
    split_rejected,
    strict,
    write_delimited,
    write_entity_text,
    write_table,
    writers,
)
from wordloom.sources.lines import _fields

CHILD = "10" + "\t" * 8


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


def rows(df):
    return [tuple(row) for row in df.collect()]


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_parents(spark):
    good = lines(spark, "1\t\tx\t\t", "2\t/m/1\tTwo\t1999\tmore")
    assert rows(strict(parse_parents(good))) == [(1, "x"), (2, "Two")]


def test_children(spark):
    fallback = [CHILD + "/m/0x\tBob D", CHILD + "12.5\tVal K\tmore"]
    good = lines(spark, CHILD + "Al P", CHILD + "Al P\t30", CHILD + "\t30", *fallback)
    labels = [row[1] for row in rows(strict(parse_children(good)))]
    assert labels == ["Al P", "Al P", "", "Bob D", "Val K"]


def test_postings(spark):
    assert rows(strict(parse_postings(lines(spark, "don't 7 2", "007 1 1")))) == [
        ("don't", 7, 2),
        ("007", 1, 1),
    ]


def test_entities(spark):
    good = lines(spark, "1\tA\tx\t\ty\t\t", "2\tB\t", "3\tC", "4\t\t")
    assert rows(strict(parse_entities(good))) == [
        (1, "A", 0, 3, ["x", "", "y"]),
        (2, "B", 0, 0, []),
        (3, "C", 0, 0, []),
        (4, "", 0, 0, []),
    ]


@pytest.mark.parametrize(
    ("parse", "bad", "problem"),
    [
        (parse_parents, "1\tx\t\t", "too few fields"),
        (parse_parents, "", "too few fields"),
        (parse_parents, " 7 \t\tx", "bad id"),
        (parse_parents, "x\t\tx", "bad id"),
        (parse_children, "1\tx", "too few fields"),
        (parse_children, CHILD + "/m/0x", "no fallback label"),
        (parse_children, CHILD + "12.5\t", "no fallback label"),
        (parse_postings, "a 1", "too few fields"),
        (parse_postings, "a  1 2", "bad id"),
        (parse_postings, "a 1 x", "bad count"),
        (parse_entities, "1", "too few fields"),
        (parse_entities, "x\tA", "bad id"),
        (parse_entities, "1#1#2\tA", "bad id"),
        (parse_documents, "x some text", "bad id"),
    ],
)
def test_malformed_lines(spark, parse, bad, problem):
    parsed = parse(lines(spark, bad))
    good, rejected = split_rejected(parsed)
    assert good.count() == 0
    assert rows(rejected) == [(bad, problem)]
    # The check may not be lost with the columns nobody asks for.
    with pytest.raises(Exception, match=problem):
        strict(parsed).count()


def test_line_ends_and_order(spark, tmp_path):
    path = write(tmp_path / "words", "b\na\r\n\rb\n don't \x0b")
    assert rows(read_query_words(spark, path)) == [
        (0, "b"),
        (1, "a"),
        (2, ""),
        (3, "b"),
        (4, " don't \x0b"),
    ]
    assert rows(query_words(spark, ["b", "a"])) == [(0, "b"), (1, "a")]


def test_positions_follow_a_split_file(spark, tmp_path):
    path = write(tmp_path / "many", "".join(f"{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        read = read_lines(spark, path)
        assert read.rdd.getNumPartitions() > 10
        values = [int(r["value"]) for r in read.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert values == list(range(20_000))


def test_missing_path_raises(spark, tmp_path):
    for read in (read_stop_words, read_parents, read_children, read_postings):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "none"))


def test_only_part_files_are_read(spark, tmp_path):
    write(tmp_path / "part-00000", "a 1 1\n")
    write(tmp_path / "my-part-1", "b 1 1\n")
    write(tmp_path / "notes", "not a posting\n")
    write(tmp_path / "_SUCCESS", "")
    (tmp_path / "part-dir").mkdir()
    assert sorted(r[2] for r in rows(read_postings(spark, str(tmp_path)))) == ["a", "b"]


@pytest.fixture
def posts(spark):
    data = [(f"w{i % 50}", i, i % 7 + 1) for i in range(1_000)]
    return spark.createDataFrame(data, schemas.POSTINGS)


def test_delimited_roundtrip(spark, tmp_path, posts):
    path = str(tmp_path / "out")
    columns = ["word", "doc_id", "occurrences"]
    write_delimited(posts, path, columns, " ", files=3, keys=["word", "doc_id"])
    # A second run replaces the first.
    write_delimited(posts, path, columns, " ", files=3, keys=["word", "doc_id"])
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    assert sorted(rows(read_postings(spark, path).select(*columns))) == sorted(rows(posts))
    for part in (tmp_path / "out").glob("part-*"):
        keys = [(w, int(d)) for w, d, _ in (line.split(" ") for line in part.read_text().splitlines())]
        assert keys == sorted(keys)


def test_delimited_defaults(spark, tmp_path):
    df = spark.createDataFrame([("a", None), (None, 2)], "w STRING, n INT")
    write_delimited(df.coalesce(1), str(tmp_path / "out"), ["w", "n"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "a\t\n\t2\n"


@pytest.mark.parametrize("part_length", [None, 2, 3])
def test_entity_text_roundtrip(spark, tmp_path, part_length):
    """Empty children in a piece, wherever they stand, come back in their place."""
    parents = spark.createDataFrame([(1, "A", 0), (2, None, 1), (3, "", 2)], schemas.PARENTS)
    labels = ["a", "", None, "d", "e"] if part_length is None else ["a", "", None, "d", ""]
    children = spark.createDataFrame([(1, c, i) for i, c in enumerate(labels)], schemas.CHILDREN)
    in_parts = part_length is not None
    entities = parent_child_list(parents, children, part_length=part_length)
    write_entity_text(entities, str(tmp_path / "out"), files=2, in_parts=in_parts)
    back = read_entities(spark, str(tmp_path / "out"), in_parts).drop("file", "pos")
    want = [
        (e, name or "", part, n, [c or "" for c in own]) for e, name, part, n, own in rows(entities)
    ]
    assert sorted(rows(back)) == sorted(want)
    if in_parts:
        with pytest.raises(Exception, match="in_parts"):
            write_entity_text(entities, str(tmp_path / "out"))


@pytest.mark.parametrize("sep", ["|", ".", "||", "\\", " "])
def test_separators_are_taken_as_they_are(spark, tmp_path, sep):
    data = [("a", 1, 2), ("", 2, 1), ("b*", 3, 1)]
    posts = spark.createDataFrame(data, schemas.POSTINGS)
    write_delimited(posts, str(tmp_path / "out"), ["word", "doc_id", "occurrences"], sep)
    back = read_postings(spark, str(tmp_path / "out"), sep).drop("file", "pos")
    assert sorted(rows(back)) == sorted(data)


@pytest.mark.parametrize("bad", ["a\tb", "a\nb", "a\rb"])
def test_fields_that_cannot_be_read_back_fail(spark, tmp_path, bad):
    df = spark.createDataFrame([(1, bad, 0, 1, ["x"]), (2, "n", 0, 1, [bad])], schemas.ENTITIES)
    for i in (1, 2):
        with pytest.raises(Exception, match="separator or line end"):
            write_entity_text(df.where(f"entity_id = {i}"), str(tmp_path / "out"))
    with pytest.raises(Exception, match="separator or line end"):
        write_delimited(df, str(tmp_path / "out"), ["entity_id", "name"])


def test_table_runs_its_source_once(spark, tmp_path, posts):
    """Range bounds are drawn from the kept rows; the kept rows are deleted."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = posts.mapInArrow(counted, posts.schema)
    write_table(source, str(tmp_path / "t"), ["word", "doc_id"], files=3)
    assert read.value == 1_000
    assert len(list((tmp_path / "t").glob("part-*"))) == 3
    folder = scratch.shared_folder(spark).removeprefix("file:")
    assert not [f for f in Path(folder).glob("stage-*")]
    write_table(posts, str(tmp_path / "u"), ["word"], file_bytes=1_000)
    assert len(list((tmp_path / "u").glob("part-*"))) > 3


@pytest.mark.parametrize("by_name", [False, True])
def test_table_roundtrip(spark, tmp_path, posts, by_name):
    if by_name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS loom LOCATION '{tmp_path}/db'")
    target = "loom.posts" if by_name else str(tmp_path / "posts")
    write_table(posts.limit(3), target, ["word", "doc_id"])
    write_table(posts, target, ["word", "doc_id"])
    back = read_table(spark, target, schemas.POSTINGS)
    assert sorted(rows(back)) == sorted(rows(posts))
    if by_name:
        spark.sql("DROP DATABASE loom CASCADE")


def test_shared_folder():
    class Context:
        def __init__(self, master):
            self.master = master
            self.folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, **conf):
            self.conf = conf
            self.sparkContext = Context(master)

    named = Session("spark://host", **{scratch.SETTING: "hdfs://all/nodes/"})
    assert scratch.new_path(named, "x").startswith("hdfs://all/nodes/x-")
    with pytest.raises(RuntimeError):
        scratch.shared_folder(Session("spark://host"))
    given = Session("spark://host")
    given.sparkContext.setCheckpointDir("hdfs://given")
    assert scratch.shared_folder(given) == "hdfs://given"
    local = Session("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local)


def test_files_are_cut_where_a_task_would_sort_too_many_rows(spark, tmp_path, posts, monkeypatch):
    """Asked for two files, a large table gets more, in order; what made the rows runs once."""
    monkeypatch.setattr(writers, "FILE_ROWS", 100)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    columns = ["word", "doc_id", "occurrences"]
    source = posts.mapInArrow(counted, posts.schema)
    write_delimited(source, str(tmp_path / "out"), columns, " ", files=2, keys=["word", "doc_id"])
    assert read.value == 1_000
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "out").glob("part-*"))]
    assert len(parts) == 10
    assert max(map(len, parts)) <= 200
    keys = [(w, int(d)) for part in parts for w, d, _ in (line.split(" ") for line in part)]
    assert keys == sorted(keys)
    write_table(posts, str(tmp_path / "t"), ["word", "doc_id"])
    assert len(list((tmp_path / "t").glob("part-*"))) == 10
    folder = scratch.shared_folder(spark).removeprefix("file:")
    assert not [f for f in Path(folder).glob("stage-*")]


@pytest.mark.parametrize("sep", ["|", " ", "\t", ".", "^", "\\", "a", "||"])
def test_fields_are_split_without_a_pattern_for_each_line(spark, sep):
    """As by a quoted pattern, and empty fields at the end go; one character needs no pattern."""
    lines = ["x" + sep + "1" + sep * 3, sep, "", "b", sep * 2 + "y", "é" + sep + "😀" + sep + "2"]
    df = spark.createDataFrame([(line,) for line in lines], "value STRING")
    split = _fields(F.col("value"), sep)
    got = [r[0] for r in df.select(split).collect()]
    for line, fields in zip(lines, got):
        want = line.split(sep)
        while len(want) > 1 and not want[-1]:
            want.pop()
        assert fields == want
    pattern = str(split).rsplit(" END", 1)[-1]
    assert ("\\Q" in pattern) == (sep == "||")
