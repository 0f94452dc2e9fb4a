"""Fixtures of the text operators' tests."""

import pytest

#: Names that the operators use inside; an input may hold columns of these names.
CLASHES = ["_id", "_h", "_text", "_row", "n", "sid", "tok", "line", "site", "score", "rank", "e", "id", "class", "logp", "_n_dropped", "mix_slot"]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank and long texts, repeated rows and ids, and clashing columns."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        df = spark.createDataFrame(rows, schema)
        for name in CLASHES:
            if name not in df.columns:
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


LONG = "alpha beta gamma delta. " * 40_000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and then runs away home again.", "en", "a", 10),
    (1, "The quick brown fox jumps over the lazy dog and then runs away home again.", "en", "a", 10),
    (1, "another text under the same identifier", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog and then runs away home again.", "en", "b", 10),
    (3, None, "en", "a", None),
    (4, "", "fr", None, 0),
    (5, " \t\n ", None, "b", 3),
    (6, "one", "en", "b", 3),
    (None, "a document without an id", "en", "c", 1),
    (None, None, None, None, None),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG, "de", "a", len(LONG)),
]
