import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.cases import documents, frame
from wordloom.llm.token_alignment import align_tokens, common_ends, cuts

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<s>a</s><|endoftext|>", "▁b  c", "\x00\x85\x1c", " \r\n", "😀 ﬁ", "a" * 700, " " * 300, "<0x41>", "▁"]


def brute(texts):
    """What the contract says, token by token."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = dict(zip(map(chr, plain), plain))
    chars |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
    rows, counts = [], Counter()
    for text in texts:
        out = {"a": [], "b": [], "groups": [], "links": []}
        rows.append(out)
        if not text:
            continue
        a = tokenizer.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(chars[c] for c in tokenizer.id_to_token(i))) for i in a.ids]
        b = []
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        if any(b"".join(x[1] for x in side) != (" " + text).encode() for side in (a, b)):
            continue
        out["a"], out["b"] = [x[0] for x in a], [x[0] for x in b]
        ends = [np.cumsum([len(x[1]) for x in side]).tolist() for side in (a, b)]
        at = [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            stop = [ends[0].index(end, at[0]) + 1, ends[1].index(end, at[1]) + 1]
            out["groups"].append((out["a"][at[0] : stop[0]], out["b"][at[1] : stop[1]]))
            at = stop
            link = (out["groups"][-1][0][-1], out["groups"][-1][1][-1])
            out["links"].append(link)
            counts[link] += 1
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    result = []
    for r in rows:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in r["groups"])
        result.append(
            (
                len(r["a"]),
                len(r["b"]),
                len(r["groups"]),
                len(r["links"]),
                sum(counts[p] == best[p[1]] for p in r["links"]),
                sum(counts[p] for p in r["links"]),
                hashlib.sha256(said.encode()).hexdigest() if r["a"] else "",
            )
        )
    return result


@pytest.mark.parametrize("table", [1 << 19, 20, 0])
def test_alignment_equals_brute_force(spark, table):
    rows = documents() + [(100 + i, t) for i, t in enumerate(ODD)]
    got = align_tokens(frame(spark, rows), A, B, table)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert align_tokens(frame(spark, []), A, B).count() == 0
    assert [tuple(r)[1:] for r in align_tokens(frame(spark, [(1, None)]), A, B).collect()] == [(0,) * 6 + ("",)]


@pytest.mark.parametrize("piece", [1, 2, 7, 1000])
def test_pieces_of_any_length(piece):
    rng = np.random.default_rng(piece)
    for n, m in ((0, 0), (0, 5), (5, 0), (40, 60), (200, 30)):
        a, b = (np.flatnonzero(rng.random(300) < k / 300) for k in (n, m))
        at = cuts(a, b, piece)
        assert (np.diff(at.sum(axis=1))[:-1] == piece).all()
        for i, j in at:
            merged = sorted([(x, 0) for x in a[:i]] + [(x, 1) for x in b[:j]])
            assert merged == sorted([(x, 0) for x in a] + [(x, 1) for x in b])[: i + j]
        i, j = common_ends(a, b, piece)
        assert (a[i] == b[j]).all() and a[i].tolist() == sorted(set(a) & set(b))
