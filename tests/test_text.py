import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from wordloom.functions import (
    children_text,
    children_text_compat,
    clean,
    label_with_fallback,
    plain_quotes,
    strict_bigint,
)
from wordloom.operators import drop_stop_words, tokens
from wordloom.operators import words as word_lists
from wordloom.sources import stop_words_from_lines, tokens_from_lines


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def words(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")
    return [row["word"] for row in tokens(docs).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('A-b,c."d"', "a bcd"),
        ("It's; [so]!", "it's; [so]!"),
        ("ΑΣ", "ας"),
        ("", ""),
        (None, None),
    ],
)
def test_clean(spark, text, expected):
    assert one(spark, clean(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('The cat-dog, the "CAT" runs.', ["the", "cat", "dog", "the", "cat", "runs"]),
        (" \t a \n\r\f b ", ["a", "b"]),
        ("a\x0bb c", ["a\x0bb", "c"]),
        ("a b", ["a b"]),
        (", . -", []),
        ("", []),
        (None, []),
    ],
)
def test_tokens(spark, text, expected):
    assert words(spark, text) == expected


def test_whole_text_is_read(spark):
    assert len(words(spark, "w " * 300_000)) == 300_000


def test_stop_words_match_to_the_letter(spark):
    toks = spark.createDataFrame([(1, "the"), (1, "e.g"), (1, "cat")], "doc_id BIGINT, word STRING")
    for stop in (["The", "e.g.", "cat"], spark.createDataFrame([("cat",), ("The",)], "word STRING")):
        kept = {row["word"] for row in drop_stop_words(toks, stop).collect()}
        assert kept == {"the", "e.g"}
    assert drop_stop_words(toks, []).count() == 3
    assert drop_stop_words(toks, None).count() == 3


@pytest.mark.parametrize("form", ["broadcast", "bitmaps", "salted"])
def test_long_stop_list(spark, monkeypatch, form):
    """Lists that are too long to broadcast go by bitmaps, and beyond those by a salted join."""
    broadcast_rows = 500_000 if form == "broadcast" else 10
    if form == "salted":
        monkeypatch.setattr(word_lists, "bitmaps_fit", lambda n: False)
    toks = spark.range(20_000).selectExpr("id AS doc_id", "concat('w', id % 3000) AS word")
    stop = spark.range(1_500).selectExpr("concat('w', 2 * id) AS word")
    kept = drop_stop_words(toks, stop, broadcast_rows)
    plan = physical_plan(kept)
    assert ("_salt" in plan) == (form == "salted")
    assert ("getbit" in plan or "bit_get" in plan) == (form == "bitmaps")
    odd = [i for i in range(20_000) if (i % 3000) % 2]
    assert sorted(row["doc_id"] for row in kept.collect()) == odd


def test_stop_list_modes(spark):
    lines = spark.createDataFrame([("the  a",), (" the",), ("",)], "value STRING")
    assert {r[0] for r in stop_words_from_lines(lines, "tokens").collect()} == {"the", "a"}
    assert {r[0] for r in stop_words_from_lines(lines, "lines").collect()} == {"the  a", " the", ""}
    with pytest.raises(ValueError):
        stop_words_from_lines(lines, "words")


def test_tokens_from_lines(spark):
    lines = spark.createDataFrame(
        [('10\tThe "cat"',), ("7\t",), ("",), (" , 3-4 x",)], "value STRING"
    )
    rows = [tuple(row) for row in tokens_from_lines(lines).collect()]
    assert rows == [(10, "the"), (10, "cat"), (3, "4"), (3, "x")]
    named = spark.createDataFrame([("m1 x",)], "value STRING")
    assert [tuple(r) for r in tokens_from_lines(named, "string").collect()] == [("m1", "x")]
    with pytest.raises(Exception, match="not an integer"):
        tokens_from_lines(named).collect()


def test_strict_bigint(spark):
    assert one(spark, strict_bigint(F.lit("+7"))) == 7
    for bad in (" 7", "7.0", "", "99999999999999999999", None):
        with pytest.raises(Exception, match="not an integer"):
            one(spark, strict_bigint(F.lit(bad).cast("string")))


@pytest.mark.parametrize(
    ("label", "expected"),
    [
        ("Al P", "Al P"),
        ("/m/0x", "B"),
        ("12.5", "B"),
        ("1234", "B"),
        ("12-3", "B"),
        ("1.75", "1.75"),
        ("123.4", "123.4"),
        ("12.55", "12.55"),
        ("", ""),
    ],
)
def test_label_with_fallback(spark, label, expected):
    assert one(spark, label_with_fallback(F.lit(label), F.lit("B"))) == expected


@pytest.mark.parametrize(
    ("children", "clean_text", "compat"),
    [
        ([], "", ""),
        (["a"], "a", "a "),
        (["a", "b"], "a b", "ab "),
        (["a", "b", "c"], "a b c", "a bc "),
        (["a", "b", "c", "d"], "a b c d", "a b cd "),
        (["a", "b", "c", "d", "e"], "a b c d e", "a b c de "),
        (["a", "b", "c", "d", "e", "f"], "a b c d e f", "a b c d ef "),
    ],
)
def test_children_text(spark, children, clean_text, compat):
    column = F.array(*map(F.lit, children)).cast("array<string>")
    assert one(spark, children_text(column)) == clean_text
    assert one(spark, children_text_compat(column)) == compat


def test_plain_quotes(spark):
    assert one(spark, plain_quotes(F.lit('Say "Yo"'))) == "Say 'Yo'"


def test_plain_integers_meet_no_pattern(spark):
    """A pattern that nothing matches leaves numbers as they are written; others need it."""
    from wordloom.functions import fields

    texts = ["7", "-12", "+5", "007", "-0", " 7", "7\t", "1.5", "x", "", None, str(2**63), str(2**63 - 1)]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r[0] for r in df.select(fields.lenient_bigint(F.col("t"))).collect()]
    assert got == [7, -12, 5, 7, 0, *[None] * 7, 2**63 - 1]
    pattern = fields.INTEGER_PATTERN
    try:
        fields.INTEGER_PATTERN = "never"
        got = [r[0] for r in df.select(fields.lenient_bigint(F.col("t"))).collect()]
    finally:
        fields.INTEGER_PATTERN = pattern
    assert got == [7, -12, *[None] * 10, 2**63 - 1]
