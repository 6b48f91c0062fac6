"""The registered queries over whole tables, against SQL or brute force."""

import base64
import hashlib
import math
import zlib
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from __spark_entry__ import oracle_sql, queries
from check_oracle import connect, difference, type_difference
from tests.llm.katz import Model
from tests.llm.test_alignment import brute as aligned
from wordloom.llm import fingerprints
from wordloom.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def rows_of(spark, name):
    return {r[0]: r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()}


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def test_all_thirteen_and_the_pipeline_are_registered():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    want = connect(SF_DIR).sql(ORACLE[name])
    assert type_difference(got, want) is None
    assert difference(got.toPandas(), want.df()) is None


def test_token_counts(spark, texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    got = rows_of(spark, "op1_token_counts")
    want = {i: len(ids) for i, ids in zip(texts, model.encode(list(texts.values())))}
    assert {i: r["n_tokens"] for i, r in got.items()} == want
    assert all(r["over_limit"] == (want[i] > 4096) for i, r in got.items())
    assert all(r["n_bytes"] == len(texts[i].encode()) for i, r in got.items())


def test_byte_bpe(spark, texts):
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encode = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary
    for i, row in rows_of(spark, "op8_byte_bpe").items():
        ids = np.array(encode(texts[i]), dtype="<u4").tobytes()
        assert row["n_tokens"] == len(ids) // 4
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_backoff(spark, texts):
    model = Model(list(texts.items()))
    got = rows_of(spark, "op4_katz_backoff")
    for i, text in texts.items():
        for name, value in model.row(i, text).items():
            assert math.isclose(got[i][name], value, rel_tol=1e-9), name
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_fingerprints(spark, texts):
    got = rows_of(spark, "op10_fingerprints")
    order = sorted(texts, reverse=True)
    prints = {}
    for i, after in zip(order, [*order[1:], order[0]]):
        text, half = texts[i], len(texts[i]) // 2
        edited = text[: len(text) - half] + texts[after][:half]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = (set(fingerprints.digests(t).tolist()) for t in (text, edited))
        assert got[i]["near_edited"] == len(a & b) / len(a | b)
        assert prints.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 10 * mean("near_next")


class Article(HTMLParser):
    """The blocks of the article, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "br"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_main_text(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = rows_of(spark, "op3_html_extraction")
    for page in pages:
        parser = Article()
        parser.feed(page["html"])
        parser.close()
        blocks = [" ".join(b.split()) for b in parser.blocks]
        want = "\n".join(b for b in blocks if b)
        row = got[page["page_id"]]
        assert row["text"] == want and row["n_chars"] == len(want) and row["url"] == page["url"]


def test_quality_on_labelled_documents(spark):
    """Labels of 400 documents find all of low quality; toxic words of four languages take more."""
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_classifier"](spark, sf_dir).collect()}
    assert len(got) == 1000
    low = [r for r in labels if (got[r["doc_id"]]["low_score"] >= 0.5) != (r["quality"] == 0)]
    clean = [r for r in labels if r["quality"] == 1 and r["toxic"] == 0 and not got[r["doc_id"]]["kept"]]
    missed = [r for r in labels if r["toxic"] == 1 and got[r["doc_id"]]["toxic_score"] < 0.5]
    assert len(low) <= 4 and len(clean) <= 4 and len(missed) <= 30


def test_token_alignment(spark, texts):
    got = rows_of(spark, "op13_token_alignment")
    assert {i: tuple(r.values())[1:] for i, r in got.items()} == dict(zip(texts, aligned(texts.values())))
