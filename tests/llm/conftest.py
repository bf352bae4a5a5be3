from __future__ import annotations

import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "src0", 10),
    (2, None, "en", "src0", None),
    (3, "", None, "src0", 0),
    (4, "word " * 5000, "en", "src0", 25000),
    (5, "same text here", "en", "src0", 14),
    (5, "same text here", "en", "src0", 14),
    (6, "same text here", "en", "src0", 14),
    (None, "a row without an id, same text here", "en", None, 30),
    (7, "\x00\t\n  ", "xx", "src0", 5),
    (8, "éÉ ÀB 漢字 😀 x" * 20, "fr", "src1", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["row", "k1", "k2", "_k1", "_cand", "fp", "w", "h", "s", "base", "count", "id", "value"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, and further columns with clashing names."""
    df = spark.createDataFrame(ODD, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark):
    """Documents of the small generated table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
