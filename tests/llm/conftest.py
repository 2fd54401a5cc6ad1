from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta", "vo", "zi") for b in ("ran", "del", "fos", "gim", "hut")]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside; documents may have them too.
CLASHING = ["row", "row_a", "row_b", "fp", "rank", "size", "block", "key", "shard", "minimizer", "marks", "w", "t", "items",
            "_text", "_at", "unit_a", "place", "root", "words"]


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


def corpus() -> list[tuple]:
    """Odd rows: nulls in every column, empty and long texts, ties, rows that repeat, copies."""
    shared = prose(1, 60)
    rows = [
        (1, prose(2, 80) + " " + shared + " " + prose(3, 40), "aa", "s1"),
        (2, shared + "\n" + prose(4, 50), "aa", "s1"),
        (3, prose(5, 120), "aa", "s2"), (4, prose(5, 120), "aa", "s2"), (3, prose(5, 120), "aa", "s2"),
        (5, "", "bb", "s2"), (6, None, None, None), (None, prose(6, 45), "bb", None), (7, "   \t\n", "bb", "s3"),
        (8, prose(7, 4000), "bb", "s3"), (9, " ".join(["same"] * 90), "aa", "s3"), (10, "one two", "aa", "s1"),
        (11, "É ÄRGER ärger Σίσυφος 😀 x", "bb", ""), (None, None, "aa", "s1"), (12, prose(5, 119) + " end", "aa", "s4"),
    ]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(corpus(), DOCS)
    return df.select("*", *[F.lit("other").alias(c) for c in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
