"""Small tables with the awkward cases, and the plain rules that results are held against."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def awkward_rows():
    """Nulls anywhere, empty and very long texts, ties, repeated rows, odd characters."""
    long_ = " ".join(f"w{i % 97}x{i * i % 89}" for i in range(30_000))
    base = "The quick brown fox jumps over the lazy dog while Ünïcode Ärger stays " * 6
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, "   \t\n ", "en", None, 5), (None, "no identifier here", "en", "b", 1), (None, None, None, None, None),
        (5, base, "en", "a", 1), (6, base.upper(), "en", "b", 1), (7, base, "en", "a", 1), (7, base, "en", "a", 1), (8, base + "tail", "en", "c", 2),
        (9, long_, "en", "a", 3), (10, long_ + " end", "en", "a", 3), (11, "single", "en", "c", 1), (12, "two words", "en", "c", 1), (13, "TWO words", "de", "c", 1),
        (14, "emoji 😀 and 中文 und ñandú x", "es", "d", 1), (15, "\x00 nul \x1c sep", "en", "d", 1), (16, "Released under the MIT License. MIT-license!", "en", "e", 1),
        (17, "line\nline\n\nline  double  blanks ", "en", "e", 1), (18, "x" * 50_000, "en", "e", 1), (19, "<|endoftext|> is text", "en", "e", 1),
    ]
    return rows


#: Extra columns whose names the operators use themselves.
CLASHES = ["norm", "hash", "head", "row", "run", "fp", "root", "size", "a", "block", "target", "taken", "score", "kept", "skey", "slice", "record", "_row", "_all", "part", "n", "y"]


@pytest.fixture(scope="session")
def awkward(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
