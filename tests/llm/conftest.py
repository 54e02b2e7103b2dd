import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    """A documents table from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: make(spark, rows)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977} all rights reserved" for i in range(4000))
    rows = [(1, "Some text CC BY here"), (1, "Some text CC BY here"), (2, None), (3, ""), (None, "no id"), (None, None),
            (4, long), (5, "  \t\n\x0b"), (6, "naïve 日本語 😀 x"), (7, "a"), (8, "Some text CC BY here")]
    return make(spark, rows)
