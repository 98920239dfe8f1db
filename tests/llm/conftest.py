import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for their own results.
CLASH = ("rank", "start", "length", "shard", "slot", "kept", "n_lines", "mix_at", "toxic_score", "__row", "__text", "__id")


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and repeated ids."""
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "délta", "épsilon", "ζήτα", "it's", "42", "x" * 30, " wide", "é"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [
        (1, "", "en", "a", 0), (2, None, None, None, None), (None, "no id at all, but a text\nand a line of it", "en", "a", 3),
        (None, None, "en", "b", 0), (3, " \t\n\x0b\x0c\r", "en", "a", 6), (4, long, "en", "b", len(long)),
        (5, "a shared line of text\nown line here", "en", "a", 5), (6, "A Shared Line of text \nother line here", "de", "b", 5),
        (7, "own line here\n\n\na shared line of text", "fr", "c", 5), (7, "the same id, another text", "fr", "c", 5),
        (8, "repeated row", "en", "a", 12), (8, "repeated row", "en", "a", 12), (8, "repeated row", "en", "a", 12),
        (9, "repeatedrow", "en", "c", 11), (10, "repeated  row", "en", "c", 13), (11, "<|endoftext|> is only text", "en", "c", 9),
    ]
    for i in range(40):
        rows.append((100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 400))), "en", rng.choice("abcd"), i))
    return rows


@pytest.fixture
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA)


@pytest.fixture
def clashing(messy):
    """The same with extra columns named like results and helpers."""
    from pyspark.sql import functions as F
    return messy.select("*", *[F.lit("extra").alias(c) for c in CLASH])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
