from __future__ import annotations

import pytest

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A function from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows to a table like ``documents``."""

    def make(rows):
        full = [(i, t, *(more or ("en",)), "s", None if t is None else len(t)) for i, t, *more in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def clashing(docs):
    """The same with extra columns whose names the operators use inside."""

    def make(rows):
        table = docs(rows)
        extra = [
            "row", "file", "pos", "digest", "kept", "hashes", "part", "n", "v", "root", "key", "ids", "score", "spans",
            "lang_pred", "sequence_id", "weight", "label", "first", "copies", "n_removed", "_metadata", "bucket",
        ]
        return table.selectExpr("*", *[f"'x' AS {c}" for c in extra])

    return make
