import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Make a documents table of (doc_id, text[, lang[, source]]) rows; ``extra`` adds columns with clashing names."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("mine"))
        return df
    return make


CASES = [
    (1, "alpha beta gamma delta"), (2, None), (3, ""), (4, "  \t\n"), (5, "alpha  beta\tgamma\ndelta"),
    (6, "word " * 30000), (None, "alpha beta gamma delta"), (7, "Ünïcode 日本 text ▁ here"), (7, "Ünïcode 日本 text ▁ here"),
    (8, "alpha beta gamma delta"), (9, "12345 !!! 678"), (10, "\u0000 nul and <|endoftext|>"),
]
"""Nulls in id and text, empty and blank texts, a long text, repeated rows, equal texts, no letters, odd characters."""


@pytest.fixture
def cases():
    return list(CASES)
