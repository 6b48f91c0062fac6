"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id bigint, text string, _id string, hits int, spans string, lang string, n_chars bigint"


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "lorem", "Ipsum", "dolor", "sit", "é", "año", "x1", "don't"]) + rng.choice(["", "", ",", "s"]) for _ in range(n))


def documents():
    """(doc_id, text) pairs; ids are null or repeated in places."""
    rng = random.Random(7)
    base = [sentence(rng, 80) for _ in range(6)]
    passage = sentence(rng, 55)
    rows = [(10 + i, text) for i, text in enumerate(base)]
    rows += [(20, base[0]), (21, base[0] + " more"), (22, base[1] + "\n" + passage)]
    rows += [(23, passage + " " + base[2]), (24, sentence(rng, 30) + " " + passage)]
    for i in range(8):
        words = base[3].split()
        words[5 * i + 3] = "edit" + str(i)
        rows.append((30 + i, " ".join(words)))
    rows += [(50, None), (51, ""), (52, "\n \t"), (53, "one"), (54, "One"), (55, "two words")]
    rows += [(None, base[4]), (None, None), (60, passage * 3), (61, "a" * 3000), (62, "ab " * 900)]
    rows += [(63, "é" * 150 + "x" + "é" * 150), (10, base[0]), (10, sentence(rng, 60))]
    rows += [(70, " ".join(base))]
    return rows


def frame(spark, rows):
    """The rows with extra columns, among them names the operators use inside."""
    full = [(i, t, "x", 1, "y", "en", None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)
