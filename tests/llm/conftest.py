import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, size long, kept string, score string, row long, `key` string, n int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    extra = (7, "x", "y", 1, "k", 3)
    long = " ".join(f"word{k % 977} sits{k % 13}." for k in range(60_000))
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", "de", "b"), (4, long, "en", None), (5, "the same text here", "en", "a"),
        (5, "the same text here", "en", "a"), (6, "the same text here", None, "b"), (None, "a row without an id", "fr", "b"),
        (None, None, None, None), (8, "one", "fr", "ü"), (9, "Zwei Wörter", "de", "ü"), (10, "1234 5678 !!", "de", "z"),
    ]
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
