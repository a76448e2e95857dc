from __future__ import annotations

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _key string, words string"


@pytest.fixture
def docs(spark):
    """Documents out of (doc_id, text) pairs, with further columns whose names operators use themselves."""

    def build(pairs):
        rows = [(number, text, "en", None, None, "k", "w") for number, text in pairs]
        return spark.createDataFrame(rows, COLUMNS)

    return build


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (None, "no id here at all, only some words to look at"),
    (5, "same words here as there are in the other text, long enough to count as one passage of its own"),
    (5, "same words here as there are in the other text, long enough to count as one passage of its own"),
    (6, "same words here as there are in the other text, long enough to count as one passage of its own"),
    (7, "x" * 50_000), (8, "word " * 20_000),
]


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, ties, repeated rows, a missing id."""
    return docs(ODD)
