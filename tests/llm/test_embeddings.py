import numpy as np
import pytest

from wordloom.llm.cover_tree import CoverTree, links_between, links_within
from wordloom.llm.embedding_links import embedding_links

SCHEMA = (
    "vec_id bigint, embedding array<float>, label int, e string, class int, links string, n int"
)


def brute(rows, least=0.95):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    rows = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    good = [
        v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and bool(np.any(v))
        for _, v in rows
    ]
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    for a in range(n):
        for b in range(a + 1, n):
            if good[a] and good[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float64) for k in (a, b))
                near[a, b] = near[b, a] = x @ y / np.sqrt((x @ x) * (y @ y)) >= least
    order = sorted(range(n), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    reached = [None] * n
    for k in order:
        if reached[k] is None:
            todo = [k]
            while todo:
                at = todo.pop()
                if reached[at] is None:
                    reached[at] = (rows[k][0],)
                    todo += np.flatnonzero(near[at]).tolist()
    return sorted(
        ((rows[k][0], int(near[k].sum()), reached[k][0], reached[k][0] == rows[k][0]) for k in range(n)),
        key=repr,
    )


def frame(spark, rows):
    full = [(i, None if v is None else list(map(lambda x: None if x is None else float(x), v)), 1, "x", 2, "y", 3) for i, v in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 6))
    rows = [(i, rng.normal(size=6)) for i in range(60)]
    for k in range(8):  # dense groups, some around the bound
        rows += [(100 + 40 * k + i, base[k] + 0.04 * (k + 1) * rng.normal(size=6)) for i in range(40)]
    rows += [(500 + i, base[9]) for i in range(30)] + [(530, 7 * base[9]), (531, -base[9])]
    rows += [(600 + i, v) for i, v in enumerate([None, [], [0] * 6, [1, None, 0, 0, 0, 0]])]
    rows += [(610, [float("nan")] * 6), (611, [float("inf"), 0, 0, 0, 0, 0]), (612, [1e-40, 0, 0, 0, 0, 0])]
    rows += [(613, [3e38, 0, 0, 0, 0, 0]), (614, [1, 1]), (615, [1, 1.01]), (616, [1.0])]
    rows += [(None, base[10]), (None, base[10]), (None, [0] * 6), (7, base[10]), (7, rng.normal(size=6))]
    rows += [(620, [-0.0, 1, 0, 0, 0, 0]), (621, [0.0, 1, 0, 0, 0, 0])]
    return rows


@pytest.mark.parametrize("shard,sample", [(8192, 1024), (40, 8), (25, 200)])
def test_links_equal_all_pairs(spark, shard, sample):
    rows = vectors()
    got = embedding_links(frame(spark, rows), shard=shard, sample=sample)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert embedding_links(frame(spark, [])).count() == 0
    alone = embedding_links(frame(spark, [(3, None)])).collect()
    assert list(map(tuple, alone)) == [(3, 0, 3, True)]


@pytest.mark.parametrize("seed", range(6))
def test_trees_equal_all_pairs(seed):
    rng = np.random.default_rng(seed)
    d, n = [(2, 300), (3, 400), (8, 300), (64, 200), (2, 1), (5, 2)][seed]
    v = rng.normal(size=(n, d))
    if seed % 2:
        v = v[rng.integers(0, max(1, n // 20), n)] + 0.1 * rng.normal(size=(n, d))
    w = rng.integers(1, 4, n)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    tree = CoverTree(v)
    assert all((tree.radius[tree.fan == 0]) == 0)
    counts, _ = links_within(tree, w[tree.order], 0.95)
    assert (counts == (near @ w)[tree.order]).all()
    k = n // 2
    if k:
        a, b = CoverTree(v[:k]), CoverTree(v[k:])
        near[:k, :k] = near[k:, k:] = False
        counts, _ = links_between(a, b, w[:k][a.order], w[k:][b.order], 0.95)
        assert (counts == (near @ w)[np.concatenate([a.order, k + b.order])]).all()


def test_a_group_of_near_copies_is_counted_without_its_pairs():
    rng = np.random.default_rng(3)
    v = np.ones((20_000, 8)) + 1e-3 * rng.normal(size=(20_000, 8))
    counts, roots = links_within(CoverTree(v), np.ones(len(v), np.int64), 0.95)
    assert (counts == len(v) - 1).all() and (roots == roots[0]).all()
