import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from tests.llm.cases import documents, frame
from tests.plans import physical_plan
from wordloom.llm.byte_bpe import Ranks, encode_texts, round_trip, with_tokens
from wordloom.llm.token_counts import count_tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["<s>a</s>", "▁b  c", "\x00\x85\x1c", " \r\n", "😀 ﬁ", "a" * 700, "the" * 400, " " * 300]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    return documents() + [(100 + i, t) for i, t in enumerate(ODD)]


@pytest.fixture(scope="module")
def tiktoken_encode():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


@pytest.mark.parametrize("table", [0, 100])
def test_piece_counts(spark, rows, table):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = count_tokens(frame(spark, rows), path, over=50, table_tokens=table)
    want = []
    for i, text in rows:
        n = len(model.encode(text or ""))
        want.append((i, len((text or "").encode()), n, n > 50))
    assert sorted_rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("table", [0, 100, 32_768])
@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_json_counts(spark, rows, name, table):
    path = public_tokenizers.path(name)
    model = Tokenizer.from_file(path)
    special = "<|startoftext|>a <|endoftext|> b<|EndOfText|>"
    rows = rows + [(200, special), (201, "Ünï  Côdé\u00a0x\u3000y don't WE'LL 123abc")]
    got = count_tokens(frame(spark, rows), path, table_tokens=table).select("doc_id", "n_tokens")
    want = [(i, len(model.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted_rows(got) == sorted(want, key=repr)


def test_counting_shuffles_nothing(spark, rows):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    assert "Exchange" not in physical_plan(count_tokens(docs, path))


def test_byte_bpe_equals_the_library(spark, rows, tiktoken_encode):
    want = []
    for i, text in rows:
        ids = np.array(tiktoken_encode(text or ""), dtype="<u4").tobytes()
        decoded = hashlib.sha256((text or "").encode()).hexdigest()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded))
    got = round_trip(frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    assert sorted_rows(got) == sorted(want, key=repr)


def test_long_pre_tokens_take_the_heap(tiktoken_encode):
    ranks = Ranks(open(RANKS, "rb").read())
    for text in ("thethe" * 200, "a" * 257, "xyzé" * 300):
        assert ranks.encode([text.encode()])[0] == np.array(tiktoken_encode(text), "<u4").tobytes()


def test_tokens_beside_all_columns(spark, rows):
    docs = frame(spark, rows)
    got = with_tokens(docs, RANKS, public_tokenizers.PATTERN)
    assert got.columns == [*docs.columns, "n_tokens", "ids", "decoded_sha256"]
    assert sorted_rows(got.select(docs.columns)) == sorted_rows(docs)


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert encode_texts(docs, RANKS, public_tokenizers.PATTERN).count() == 0
