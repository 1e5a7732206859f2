from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) pairs; ``extra`` columns have clashing names."""

    def make(rows, extra=False):
        pairs = [row if isinstance(row, tuple) else (at, row) for at, row in enumerate(rows)]
        table = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in pairs], DOCUMENTS)
        if extra:
            for name in ("digest", "salt", "kind", "block", "label", "score", "slot", "piece", "batch", "keep_id"):
                table = table.selectExpr("*", f"'x' AS `{name}`")
        return table.repartition(3)

    return make


@pytest.fixture
def prose():
    """Random words, the same for the same seed."""

    def make(seed, words):
        chooser = random.Random(seed)
        parts = ["an", "er", "re", "on", "ti", "ou", "le", "th", "in", "es"]
        return " ".join("".join(chooser.choices(parts, k=chooser.randint(1, 4))) for _ in range(words))

    return make


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, "\x00   é"), (7, "w " * 30000)]


@pytest.fixture
def odd_pairs():
    """Nulls, blanks, ties, repeated rows and a very long text."""
    return ODD


@pytest.fixture
def odd(documents):
    """The same as a table, with extra columns."""
    return documents(ODD, extra=True)


@pytest.fixture
def none(documents):
    return documents([("x", "y")][:0])
