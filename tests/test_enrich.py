import random

import pytest

from tests.plans import physical_plan
from wordloom import schemas
from wordloom.operators import child_rows, last_per_key, parent_child_list, parents_only
from wordloom.plans import build_entities

PARENTS = [(10, "Heat", 0), (2, 'Say "Yo"', 1), (7, "None", 2)]
CHILDREN = [(10, "Al P", 0), (10, "Bob D", 1), (2, "Jo S", 2), (10, "Val K", 3), (99, "Lost", 4)]


def frames(spark, parents, children):
    return (
        spark.createDataFrame(parents, schemas.PARENTS),
        spark.createDataFrame(children, schemas.CHILDREN),
    )


def expected(parents, children, part_length):
    """The rows by brute force."""
    names = {}
    for entity_id, name, _ in sorted(parents, key=lambda row: row[2]):
        names[entity_id] = name
    rows = []
    for entity_id, name in names.items():
        mine = [c[1] for c in sorted(children, key=lambda row: row[2]) if c[0] == entity_id]
        for part in range(max(1, -(-len(mine) // part_length))):
            piece = mine[part * part_length : (part + 1) * part_length]
            rows.append((entity_id, name, part, len(mine), piece))
    return sorted(rows)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_small_lists(spark):
    got = rows(build_entities(*frames(spark, PARENTS, CHILDREN)))
    assert got == [
        (2, "Say 'Yo'", 0, 1, ["Jo S"]),
        (7, "None", 0, 0, []),
        (10, "Heat", 0, 3, ["Al P", "Bob D", "Val K"]),
    ]


def test_schema(spark):
    entities = parent_child_list(*frames(spark, PARENTS, CHILDREN), part_length=2)
    want = spark.createDataFrame([], schemas.ENTITIES)
    assert entities.dtypes == want.dtypes


def test_parents_only(spark):
    parents, _ = frames(spark, PARENTS, CHILDREN)
    assert rows(parents_only(parents)) == sorted((p[0], p[1]) for p in PARENTS)


def test_repeated_parents_and_children(spark):
    parents = [*PARENTS, (10, "Heat 2", 9), (10, "Heat 1", 8)]
    children = [*CHILDREN, (2, "Jo S", 7), (None, "Nobody", 8)]
    got = rows(parent_child_list(*frames(spark, parents, children)))
    assert got == expected(parents, children, 100)
    assert (2, 'Say "Yo"', 0, 2, ["Jo S", "Jo S"]) in got


def skewed(n=6_000, seed=1):
    """A third of the children belong to parent 1, another third to the unknown parent 0."""
    rng = random.Random(seed)
    positions = rng.sample(range(1 << 20), n)
    owners = [rng.choice([0, 1, rng.randrange(2, 400)]) for _ in range(n)]
    children = [(owner, f"c{pos}", pos) for owner, pos in zip(owners, positions)]
    parents = [(i, f"p{i}", i) for i in range(1, 500)] + [(1, "again", 1_000)] * 300
    return parents, children


@pytest.mark.parametrize("part_length", [1, 7, 500, 100_000])
def test_skewed_lists(spark, part_length):
    parents, children = skewed()
    got = rows(parent_child_list(*frames(spark, parents, children), part_length=part_length))
    assert got == expected(parents, children, part_length)


@pytest.mark.parametrize("gap", [1, 1_000_000])
def test_ranks_do_not_depend_on_positions(spark, gap):
    _, children = skewed(2_000)
    df = spark.createDataFrame([(e, l, p * gap) for e, l, p in children], schemas.CHILDREN)
    got = rows(child_rows(df))
    want = []
    for owner in {c[0] for c in children}:
        mine = sorted((p, l) for e, l, p in children if e == owner)
        want += [(owner, rank, label) for rank, (_, label) in enumerate(mine)]
    assert got == sorted(want)


def test_parts_end_by_bytes(spark):
    children = [(1, "x" * n, n) for n in range(1, 9)]
    df = spark.createDataFrame(children, schemas.CHILDREN)
    parents = spark.createDataFrame([(1, "p", 0)], schemas.PARENTS)
    got = rows(parent_child_list(parents, df, part_length=6, part_bytes=6))
    assert [r[2] for r in got] == list(range(len(got)))
    assert [c for r in got for c in r[4]] == ["x" * n for n in range(1, 9)]
    assert all(sum(map(len, r[4])) < 6 + 8 for r in got) and len(got) > 3
    with pytest.raises(ValueError):
        parent_child_list(parents, df, part_bytes=6)


def test_null_order_comes_first(spark):
    df = spark.createDataFrame([("k", "v", None), ("j", "a", 1), ("j", "b", None)], "k STRING, v STRING, pos INT")
    assert rows(last_per_key(df, ["k"], ["pos"])) == [("j", "a", 1), ("k", "v", None)]


def test_ranks_have_no_window_over_a_parent(spark):
    """Rows are numbered within ranges; only a row per range is summed by parent."""
    _, children = frames(spark, *skewed(500))
    plan = physical_plan(child_rows(children))
    assert "row_number()" in plan
    for line in plan.splitlines():
        if "row_number()" in line and "windowspecdefinition" in line:
            assert "_range" in line.split("windowspecdefinition")[1].split("ASC")[0]


def test_two_order_columns(spark):
    """Positions start again in every file, and the file may be unknown."""
    files = ["b", "a", None]
    children = [(1, f"{f}{p}", f, p) for f in files for p in range(5)]
    schema = "entity_id BIGINT, label STRING, file STRING, pos BIGINT"
    df = spark.createDataFrame(children, schema)
    parents = spark.createDataFrame([(1, "p", "x", 0)], schema.replace("label", "name"))
    in_order = [f"{f}{p}" for f in (None, "a", "b") for p in range(5)]
    for part_length in (4, 100):
        parts = parent_child_list(parents, df, ["file", "pos"], part_length).orderBy("part").collect()
        assert [c for part in parts for c in part["children"]] == in_order
        assert {part["n_children"] for part in parts} == {15}


def test_plain_plan(spark):
    """Without long lists: one shuffle of the children, no broadcast by hint."""
    lists = parent_child_list(*frames(spark, PARENTS, CHILDREN))
    plan = physical_plan(lists)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_collect_list" in plan
    assert "Python" not in plan
    logical = lists._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in logical
