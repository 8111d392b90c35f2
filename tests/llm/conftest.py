import pytest


@pytest.fixture
def texts(spark):
    """A table with nulls, an empty and a very long text, ties, repeated rows and clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1, "x"), (2, base, "en", "a", 1, "x"), (2, base, "en", "a", 1, "x"), (3, base.replace("word59", "end"), "en", None, 2, "y"), (4, None, None, "a", None, None),
        (5, "", "en", "b", 0, ""), (6, long, "fr", "b", 9, "z"), (None, base, "en", "a", 3, "n"), (7, "two words", "en", "b", 1, "q"), (8, " \t\n ", "de", "c", 1, "q"),
        (9, "other text " * 40, "de", "c", 1, "q"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, k string")


@pytest.fixture
def empty(texts):
    return texts.where("doc_id < 0")
