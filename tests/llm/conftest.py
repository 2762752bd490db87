from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) pairs, with the columns of the test table."""

    def build(pairs):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and blank texts, ties, repeated rows, a very long text, and clashing column names."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{k % 997}x{k}" for k in range(30_000))
    one = " ".join(f"same{k}" for k in range(80))
    pairs = [
        (1, None), (2, ""), (3, " \n\t\n"), (None, one), (None, None), (4, one), (4, one), (5, one), (5, "other text"),
        (6, long), (7, "word " * 3000), (8, "Ünï ÉCOLE — ﬁn"), (9, "x"), (10, "\n".join([one] * 3)),
    ]
    clash = {c: F.lit("mine") for c in CLASHES}
    return documents(pairs).withColumns(clash)


#: Column names that operators use or add.
CLASHES = [
    "id", "key", "node", "n_words", "kept", "score", "spans", "host", "piece", "offset", "length", "label", "text_a",
    "n_lines", "items", "class_id", "digest", "own", "body", "window", "upper_share", "start", "a", "b",
]


@pytest.fixture(scope="session")
def none(documents):
    return documents([])
