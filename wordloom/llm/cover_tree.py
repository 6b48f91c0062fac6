"""A cover tree over directions, and the traversal of two trees at once.

A node covers the points behind it from its centre; radii of the levels are
powers of two, halving downwards, and levels at which nothing parts are left out.
Points are kept in the order of the tree, so a node's points are one slice.

Distances are those between unit vectors. Products in 32 bits carry a proven
error bound: what they cannot decide is decided in double precision.
"""

from __future__ import annotations

import math

import numpy as np

BUCKET = 8  # points that hang directly under one node
FINEST = 2.0**-11  # below this radius points are not parted further
BLOCK = 512  # centres or rows compared at once
SMALL = 1_024  # pairs of points under two nodes that are compared without descending further
PAIRS = 65_536  # of these at once


def scaled(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two each, so that squares stay finite, and their norms."""
    values = np.asarray(values, dtype=np.float64)
    if not values.size:
        return values, np.zeros(len(values))
    _, exponent = np.frexp(np.abs(values).max(axis=1))
    values = np.ldexp(values, -exponent[:, None])
    return values, np.sqrt(np.einsum("ij,ij->i", values, values))


class CoverTree:
    """Points ``order`` of the input, and nodes by columns.

    Node k has the points from ``first[k]`` to ``last[k]``, the centre at place
    ``centre[k]``, all within ``radius[k]`` of it, and the nodes from ``down[k]``
    to ``down[k] + fan[k]`` below; a node without nodes below is one point.
    """

    def __init__(self, values: np.ndarray):
        self.values, self.norm = scaled(values)
        unit = (self.values / self.norm[:, None]).astype(np.float32)
        self.error = error_bound(values.shape[1])
        n = len(unit)
        self.order = np.arange(n)
        first, last, down, fan = [0], [n], [0], [0]
        node = 0
        while node < len(first):
            at, end = first[node], last[node]
            if end - at > 1:
                parts = self._parted(unit, self.order[at:end])
                down[node], fan[node] = len(first), len(parts)
                for part in parts:
                    first.append(at)
                    self.order[at : at + len(part)] = part
                    at += len(part)
                    last.append(at)
                    down.append(0)
                    fan.append(0)
            node += 1
        self.values, self.norm = self.values[self.order], self.norm[self.order]
        self.first, self.last, self.down, self.fan = map(np.array, (first, last, down, fan))
        self._settle()

    @classmethod
    def stored(cls, values, first, last, down, fan, radius) -> CoverTree:
        """The tree of columns that were kept; ``values`` in the tree's order."""
        tree = cls.__new__(cls)
        tree.values, tree.norm = scaled(values)
        tree.error = error_bound(tree.values.shape[1])
        tree.order = np.arange(len(tree.values))
        tree.first, tree.last, tree.down, tree.fan = first, last, down, fan
        tree._settle(radius)
        return tree

    def _settle(self, radius: np.ndarray | None = None) -> None:
        self.unit = (self.values / self.norm[:, None]).astype(np.float32)
        self.centre = self.first  # a node's own centre stands first, on every level
        if radius is None:
            radius = np.zeros(len(self.first))
            for node in np.flatnonzero(self.fan):
                mine = self.unit[self.first[node] : self.last[node]]
                radius[node] = self.farthest(float((mine @ mine[0]).min()))
        self.radius = radius

    def farthest(self, cosine: float) -> float:
        return math.sqrt(max(0.0, 2 - 2 * (cosine - self.error)))

    def _parted(self, unit: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
        mine = unit[points]
        radius = self.farthest(float((mine @ mine[0]).min()))
        level = 2.0 ** (math.ceil(math.log2(radius)) - 1)  # the centre does not reach all
        if len(points) <= BUCKET or level < FINEST:
            return [points[i : i + 1] for i in range(len(points))]
        return self._net(mine, points, level)

    @staticmethod
    def _net(mine: np.ndarray, points: np.ndarray, level: float) -> list[np.ndarray]:
        """Points by centres that are farther than ``level`` from each other; the first is one."""
        least = np.float32(1 - level * level / 2)
        rest, parts = np.arange(len(points)), []
        while len(rest):
            near = mine[rest[:BLOCK]] @ mine[rest].T >= least
            free = np.ones(len(rest), dtype=bool)
            for i in range(len(near)):
                if free[i]:
                    hit = near[i] & free
                    hit[i] = True
                    parts.append(points[rest[hit]])
                    free &= ~hit
            rest = rest[free]
        if len(parts) == 1:  # rounding alone kept the points apart
            parts = [parts[0][:1], parts[0][1:]]
        return parts

    def nodes(self) -> int:
        return len(self.first)


def error_bound(dimension: int) -> float:
    """Of a product of two rounded unit vectors in 32 bits."""
    return (dimension + 16) * 2.0**-22


class Links:
    """Counts and components over the points of one tree, or of two side by side."""

    def __init__(self, weights: np.ndarray, offset: int):
        self.total = np.concatenate([[0], np.cumsum(weights)])
        self.weights, self.offset = weights, offset
        n = len(weights)
        self.parent = np.arange(n)
        self.added = np.zeros(n, dtype=np.int64)
        self.steps = np.zeros(n + 1, dtype=np.int64)  # differences of what whole slices get
        self.chain = np.zeros(n + 1, dtype=np.int64)  # slices of which all points are one

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Points a[i] and b[i] are linked: hook the greater root to the lesser, until none is left."""
        while len(a):
            a, b = self._roots(a), self._roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def _roots(self, points: np.ndarray) -> np.ndarray:
        found = self.parent[points]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[points] = found
                return found
            found = above

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.added, a, self.weights[b])
        np.add.at(self.added, b, self.weights[a])
        self.join(a, b)

    def slices(self, a0, a1, b0, b1) -> None:
        """Every point of a slice is linked with every point of another."""
        for p0, p1, q0, q1 in ((a0, a1, b0, b1), (b0, b1, a0, a1)):
            weight = self.total[q1] - self.total[q0]
            np.add.at(self.steps, p0, weight)
            np.add.at(self.steps, p1, -weight)
            np.add.at(self.chain, p0, 1)
            np.add.at(self.chain, p1 - 1, -1)
        self.join(a0, b0)

    def within(self, a0, a1) -> None:
        """All points of a slice are linked with each other."""
        weight = self.total[a1] - self.total[a0]
        np.add.at(self.steps, a0, weight)
        np.add.at(self.steps, a1, -weight)
        for at, end in zip(a0, a1):
            self.added[at:end] -= self.weights[at:end]
        np.add.at(self.chain, a0, 1)
        np.add.at(self.chain, a1 - 1, -1)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """(linked weight, root) of each point."""
        joined = np.flatnonzero(np.cumsum(self.chain)[:-1] > 0)
        self.join(joined, joined + 1)
        counts = self.added + np.cumsum(self.steps)[:-1]
        return counts, self._roots(np.arange(len(self.parent)))


def links_within(tree: CoverTree, weights: np.ndarray, least: float) -> tuple:
    """(counts, roots) of the links between points of a tree, at cosine ``least`` or more."""
    links = Links(weights, 0)
    if len(weights):
        _traverse(tree, tree, links, least, [(0, 0)])
    return links.result()


def links_between(
    a: CoverTree, b: CoverTree, weights_a: np.ndarray, weights_b: np.ndarray, least: float
) -> tuple:
    """(counts, roots) over the points of ``a``, then of ``b``, of links between the two."""
    links = Links(np.concatenate([weights_a, weights_b]), len(weights_a))
    _traverse(a, b, links, least, [(0, 0)])
    return links.result()


def _traverse(a: CoverTree, b: CoverTree, links: Links, least: float, stack: list) -> None:
    """Descend pairs of nodes: none linked by the radii, all linked by them, or look below."""
    same = a is b
    reach = math.sqrt(2 - 2 * least)
    while stack:
        p, q = stack.pop()
        if same and p == q:
            if not a.fan[p]:
                continue
            if 2 * a.radius[p] <= reach - 1e-9:
                links.within(a.first[p : p + 1], a.last[p : p + 1])
                continue
        above, below = _below(a, p), _below(b, q)
        for some, points_a in above:
            for behind, points_b in below:
                for i0 in range(0, len(some), BLOCK):
                    rows = some[i0 : i0 + BLOCK]
                    if same and p == q:
                        cols = behind[behind >= rows[0]] if points_a == points_b else behind
                    else:
                        cols = behind
                    if len(cols):
                        stack += _compared(
                            a, b, rows, cols, links, least, points_a and points_b, same and p == q
                        )


def _compared(a, b, rows, cols, links: Links, least: float, points: bool, itself: bool) -> list:
    """What nodes ``rows`` of a and ``cols`` of b settle at once goes to ``links``; the pairs left."""
    reach, offset = math.sqrt(2 - 2 * least), links.offset
    error = max(a.error, b.error)
    cosine = a.unit[a.centre[rows]] @ b.unit[b.centre[cols]].T
    if points:
        at = np.flatnonzero(cosine.ravel() >= np.float32(least - error))
        i, j = np.divmod(at, len(cols))
        i, j, cosine = rows[i], cols[j], cosine[i, j]
        if itself:
            once = i < j
            i, j, cosine = i[once], j[once], cosine[once]
        linked = cosine >= least + error
        doubt = np.flatnonzero(~linked)
        linked[doubt] = _cosines(a, b, a.first[i[doubt]], b.first[j[doubt]]) >= least
        if linked.any():
            links.pairs(a.first[i[linked]], b.first[j[linked]] + offset)
        return []
    away = a.radius[rows][:, None] + b.radius[cols][None, :]
    limit = 1 - np.square(np.minimum(away + (reach + 1e-9), 2)) / 2 - error
    i, j = np.nonzero(cosine >= limit)
    away, cosine = away[i, j], cosine[i, j].astype(np.float64)
    i, j = rows[i], cols[j]
    left = []
    if itself:  # a pair of children once: both orders are met if only one of them has points below
        once = i < j
        left = [(k, k) for k in i[i == j].tolist()]
        i, j, away, cosine = i[once], j[once], away[once], cosine[once]
    farthest = np.sqrt(np.maximum(0, 2 - 2 * (cosine - error))) + away
    whole = farthest <= reach - 1e-9
    x, y = i[whole], j[whole]
    links.slices(a.first[x], a.last[x], b.first[y] + offset, b.last[y] + offset)
    i, j = i[~whole], j[~whole]
    size = (a.last[i] - a.first[i]) * (b.last[j] - b.first[j])
    few = size <= SMALL
    _by_points(a, b, i[few], j[few], size[few], links, least)
    return [*left, *zip(i[~few].tolist(), j[~few].tolist())]


def _by_points(a, b, i, j, size, links: Links, least: float) -> None:
    """All points of small nodes against each other, for many pairs of nodes at once."""
    ends = np.cumsum(size)
    at = 0
    while at < len(size):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        n = size[at:end]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(b.last[j[at:end]] - b.first[j[at:end]], n)
        x = np.repeat(a.first[i[at:end]], n) + place // width
        y = np.repeat(b.first[j[at:end]], n) + place % width
        cosine = np.einsum("ij,ij->i", a.unit[x], b.unit[y])
        near = cosine >= least - max(a.error, b.error)
        x, y = x[near], y[near]
        linked = _cosines(a, b, x, y) >= least
        links.pairs(x[linked], y[linked] + links.offset)
        at = end


def _below(tree: CoverTree, node: int) -> list[tuple[np.ndarray, bool]]:
    """The nodes one level down, single points apart; a single point stays as it is."""
    if not tree.fan[node]:
        return [(np.array([node]), True)]
    nodes = np.arange(tree.down[node], tree.down[node] + tree.fan[node])
    points = tree.fan[nodes] == 0
    return [(x, kind) for x, kind in ((nodes[points], True), (nodes[~points], False)) if len(x)]


def _cosines(a: CoverTree, b: CoverTree, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for at in range(0, len(i), 65_536):
        x, y = i[at : at + 65_536], j[at : at + 65_536]
        dots = np.einsum("ij,ij->i", a.values[x], b.values[y])
        out[at : at + 65_536] = dots / (a.norm[x] * b.norm[y])
    return out
