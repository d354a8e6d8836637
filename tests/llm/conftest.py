from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, part int, size string, node long, label string,"
    " kept boolean, line int, `two words` string"
)


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text, source); the table has more columns, whose names operators use inside."""

    def make(*rows):
        full = [(*r[:2], None, r[2] if len(r) > 2 else "s", None, 7, "x", 7, "x", True, 7, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd_docs(docs):
    """Null, empty, blank, very long, repeated and tied rows, and rows without a doc_id or source."""
    long_text = words(30_000, 1)
    return docs(
        (1, "One two THREE four. " + words(80, 2)), (2, "one two three four. " + words(80, 2), None), (3, None), (4, ""), (5, " \n\t "),
        (6, long_text), (7, long_text + " end", "t"), (8, words(60, 3)), (8, words(60, 3)), (8, words(70, 4)), (None, words(60, 5)),
        (None, "One two THREE four. " + words(80, 2), None), (9, "é 漢字 \U0001f600 " + words(55, 6), ""), (10, "x"), (11, "x"),
    )


def rows(df, *columns):
    """Rows as a sorted list; nulls come first."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: [(v is not None, v) for v in r])
