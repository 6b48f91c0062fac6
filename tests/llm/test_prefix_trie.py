import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from wordloom.llm.prefix_trie import lexsorted, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv int, seq string, depth int, words int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rebuilt(rows):
    """The turns (role, text) of each conversation, in its new form."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
        own[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(turns)] for c, turns in own.items()}
    out = {None: own[None]} if None in own else {}
    for c in own:
        if c is not None:
            h = zlib.crc32(str(c).encode()) % 4
            head = c - int(np.fmod(c, 20))
            out[c] = own.get(head, [])[:h] + own[c][h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    nodes = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    order = lambda c: (c is not None, c or 0)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(WORDS.findall(p[-1][1])) for p in below if p)
        ends = sorted((c for c in members if len(convs[c]) == len(path)), key=order)
        ends = ",".join("" if c is None else str(c) for c in ends)
        out.append(
            (
                min(members, key=order),
                len(path),
                min(nodes[path[:-1]], key=order) if path else None,
                len(members),
                len(children),
                len(leaves),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def frame(spark, rows):
    full = [(*r, 1, "x", 2, 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


def conversations(seed, hot):
    rng = random.Random(seed)
    texts = ["", "a", "b c", " d\te  f", None, "é ü"]
    rows = []
    for c in [*range(0, 70), 100, 119, 121, -1, -20, -21, 10**12 + 7, None]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 25 if c and c % 7 == 0 else 2])):
            turn = rng.choice([t, t, t, t, None]) if c in (5, 25) else t
            role = rng.choice(["user", "user", "assistant", None]) if rng.random() < 0.2 else "user"
            text = texts[1] if rng.random() < hot else rng.choice(texts)
            rows.append((c, turn, role, text))
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (7, 1, "x", "long " * 3000)]
    for c in range(200, 260):  # copies, dealt over many ranges
        rows += [(c, t, "user", f"same {t}") for t in range(20)]
    return rows


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,hot,turns", [(1, 0.0, 10**6), (2, 0.7, 60), (3, 0.95, 25)])
def test_nodes_equal_brute_force(spark, seed, hot, turns):
    rows = conversations(seed, hot)
    got = prefix_trie(frame(spark, rows), shard_turns=turns)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    assert got.columns == names.split()
    assert sorted_rows(got) == brute(rows)


def test_turnless_conversations(spark):
    rows = [(c, 0, "u", "t") for c in range(21, 30)]
    assert sorted_rows(prefix_trie(frame(spark, rows))) == brute(rows)
    assert prefix_trie(frame(spark, [])).count() == 0


def test_matrices_in_any_width():
    rng = np.random.default_rng(4)
    length = rng.integers(0, 30, 300)
    ids = rng.integers(0, 2, (length.sum(), 2)).astype(np.uint64)
    ids[rng.random(len(ids)) < 0.8] = 1
    start = np.cumsum(length) - length
    rows = [[tuple(x) for x in ids[s : s + n].tolist()] for s, n in zip(start, length)]
    conv = rng.permutation(300)
    want = sorted(range(300), key=lambda r: (rows[r], conv[r]))
    shared = [0]
    for a, b in zip(want, want[1:]):
        n = 0
        while n < min(len(rows[a]), len(rows[b])) and rows[a][n] == rows[b][n]:
            n += 1
        shared.append(n)
    for width in (1, 3, 8):
        order, lcp = lexsorted(ids, start, length, conv, width)
        assert order.tolist() == want and lcp.tolist() == shared
