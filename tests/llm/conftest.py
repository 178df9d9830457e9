"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

import pytest

CLASHING = "score double, size long, key string, unit string, id long, shard int, times int, p double, line string"


def prose(rng, n, letters="abcdefghijklmnopqrstuvwxyz"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    rng = random.Random(5)
    base = prose(rng, 300)
    words = base.split()
    edited = words[:]
    edited[40] = "changed"
    long = "\n".join(prose(rng, 400) for _ in range(60))
    passage = prose(rng, 70)
    texts = [
        (1, base), (2, base), (2, base), (3, " ".join(edited)), (4, base.upper()),
        (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "one two"), (10, "One  two"), (None, base),
        (11, long), (12, "a" * 50_000), (13, "é漢字😀 ß " * 400), (14, prose(rng, 90) + " " + passage),
        (15, passage + "\n" + prose(rng, 80)), (16, "x # * $ % & | < >\nx # * $ % & | < >\n\n"),
        (17, "w1 w2 w3 w4 w5 w6 w7 w8 " * 12), (18, prose(rng, 40) + "\n" + prose(rng, 12)),
    ]
    texts += [(100 + i, prose(rng, 60)) for i in range(40)]
    sources = ["b", "a", None, "", "ä", "b"]
    return [
        (doc, text, ["en", None, "fr"][i % 3], sources[i % 6], None if i % 5 == 0 else len(text or ""))
        for i, (doc, text) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward_rows, "doc_id long, text string, lang string, source string, n_chars long")
    for field in CLASHING.split(", "):
        name, kind = field.split()
        docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs


@pytest.fixture(scope="session")
def none(awkward):
    return awkward.limit(0)
