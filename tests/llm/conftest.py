from __future__ import annotations


import pytest

from billshift.sources.writers import materialise

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
NEAR = " ".join(["other", *WORDS[1:]])

#: Nulls in every column, empty and long texts, ties, repeated rows, texts without words or letters.
ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, LONG, "en", None, None),
    (4, LONG, "en", "b", None),
    (4, LONG, "en", "b", None),
    (5, NEAR, "de", "b", None),
    (6, "  \t\n ", "de", "", None),
    (7, "12 34 ½", "fr", "c", None),
    (8, "one two", "en", "c", None),
    (9, "One TWO", "en", "c", None),
    (10, "é▁ß \U0001f600 x", "de", "c", None),
    (11, "the quick brown fox " * 30000, "en", "c", None),
    (None, "no id here at all", "en", "c", None),
    (12, "password = hunter2hunter2 " + "ab" * 20, "en", "c", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, as a table read from files, with columns whose names clash."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD_ROWS, DOCS)
    clash = {c: F.lit("x") for c in ("score", "lang_pred", "ids", "size", "target", "digest", "file", "bucket", "n")}
    return materialise(frame.withColumns(clash), "odd")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


