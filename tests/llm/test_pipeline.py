"""The pipeline on a small corpus, stage by stage against brute force."""

import base64
import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_documents import NAMES, components

BENCHMARK = "What is the name of the river that runs through every city of the far plain"


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs, labels = [], []
    for i in range(500):
        low, toxic = i % 6 == 0, i % 9 == 4
        text = say(60)
        if low:
            text = " | ".join(text.split())
        if toxic:
            text = text.replace(" ", " vilest ", 3)
        docs.append((i, text))
        if i % 5:
            labels.append((i, int(not low), int(toxic)))
    passage = say(40)
    docs += [(600, docs[1][1]), (601, docs[1][1] + " w1"), (602, say(30) + " " + passage)]
    docs += [(603, passage + " " + say(30)), (604, say(20) + " " + BENCHMARK + " " + say(20))]
    return docs, labels


def without_bytes(docs, window=100):
    seen, out = set(), []
    for doc, text in sorted(docs):
        raw = text.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for p in range(len(raw) - window + 1):
            if raw[p : p + window] in seen:
                gone[p : p + window] = True
            seen.add(raw[p : p + window])
        out.append((doc, bytes(b for b, g in zip(raw, gone) if not g).decode()))
    return out


def test_stages_against_brute_force(spark, tmp_path):
    docs, labels = corpus()
    frame = spark.createDataFrame(
        [(i, t, "en", f"src{i % 3}", len(t), 7) for i, t in docs],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, spans int",
    )
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    items = spark.createDataFrame([(1, BENCHMARK)], "item_id bigint, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))

    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    want = [(i, t) for i, t in docs if "|" not in t and "vilest" not in t]
    want = [r for r, c in zip(want, components(want, 5, 80)) if c[3]]
    want = without_bytes(want)
    own = NAMES.findall(BENCHMARK.lower())
    ranks_file = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}
    encode = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary
    assert set(got) == {i for i, _ in want} and not {600, 601} & set(got)
    for i, text in want:
        if i == 604:
            text = text.replace(BENCHMARK, "")
            assert not set(own) & set(NAMES.findall(got[i]["text"]))
        assert got[i]["text"] == text
        ids = np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist()
        assert ids == encode(text) and got[i]["n_tokens"] == len(ids) and got[i]["spans"] == 7
    # The passage stays where it came first, and only there.
    assert len(got[602]["text"]) > 300 > len(got[603]["text"])


def test_every_stage_but_the_last_keeps_the_columns(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert 0 < docs.count() <= n
        n = docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
