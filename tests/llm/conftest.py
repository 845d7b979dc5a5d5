from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("copies", T.LongType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int, text string"


def make_docs(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(i, t, lang, s, None, "k", 7, None, 3) for i, t, lang, s in rows], DOCS)


def odd_rows():
    """Nulls in every column, empty and white-space texts, one very long text, ties, repeated rows."""
    rng = random.Random(4)
    words = [a + b + c for a in "bdfg" for b in "aeiou" for c in ("l", "rn", "st")]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    base = [prose(60) for _ in range(6)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[0], "en", "s1") for i in range(5)]  # exact copies
    rows += [(200, base[1] + " more", "en", "s2"), (201, "start " + base[1], "en", "s0")]  # near copies
    rows += [(300, None, None, None), (301, "", "en", "s0"), (302, " \t\n\x0b\x0c\r ", "de", "s1"), (303, "One two", "en", None), (304, "one TWO", None, "s2")]
    rows += [(305, "ein\x1czwei\x85drei vier <|endoftext|> naïve ΑΣ don't 12½", "de", "s0"), (306, "?!… 123 ½", "fr", "s1")]
    rows += [(400, prose(30_000), "en", "s0"), (401, "x" * 70_000 + " tail " + "é" * 70_000, "fr", "s2")]  # very long
    rows += [(500, base[2], "en", "s2"), (500, base[2], "en", "s2"), (500, "another text with one id", "en", "s2")]  # repeated rows, equal ids
    rows += [(None, base[3], "en", "s0"), (None, "a row without an id", None, "s1")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return make_docs(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 1, 0, "x") for i in range(6)] + [(100, 0, 1, "y"), (101, 0, 1, "y"), (303, None, None, None), (300, 1, 0, None), (999, 0, 1, None), (None, 1, 1, None), (2, 1, 0, "x")]
    return spark.createDataFrame(rows, LABELS)
