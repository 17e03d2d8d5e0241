from __future__ import annotations

import pytest
from samples import prose

@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = prose(1, 30_000)
    base = prose(2, 400)
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, base, None, "b"), (3, base, None, "b"),
        (4, None, "en", None), (5, "", None, "a"), (None, prose(3, 50), "de", "b"), (None, None, None, None),
        (6, long, "en", "a"), (7, long + " tail", "en", "a"), (8, "one two", "fr", "c"), (8, "one two three four", "fr", "c"),
        (9, "é" * 300 + " 漢字 \x00   x", "xx", "d"), (10, "   \t\n ", "en", "d"), (11, base.replace("a", "é", 3), "en", "b"),
        (12, prose(4, 80), "en", "a"), (13, prose(5, 80) + " " + prose(2, 400), "en", "b"), (14, "x" * 250 + "y" + "x" * 250, "en", "b"),
        (15, "<|endoftext|> a<|endoftext|>b's  end", "en", "b"),
    ]
    rows = [(*r, 0, "kept", 1, "size") for r in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, kept string, _key int, size string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_documents(spark, odd_documents):
    return spark.createDataFrame([], odd_documents.schema)
