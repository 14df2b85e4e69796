import pytest

LONG = "Das ist ein langer Text. " * 4_000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls everywhere, an empty and a very long text, repeated rows, and columns that bear names of results."""
    rows = [
        (1, "Plain words of one text", "en", "b", None),
        (1, "Plain words of one text", "en", "b", None),
        (2, "", "en", "a", 0),
        (3, None, None, None, None),
        (None, "No id here, all rights reserved", "en", "a", 3),
        (4, LONG, "de", "c", 1),
        (5, "   \t\n ", "en", "b", 2),
        (6, "Ünïcödé größe ПРИВЕТ 漢字 \U0001f600", "xx", "\U0001f600", 2),
    ]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    clash = "'x' AS n_words, 1 AS items, 2 AS spans, 3 AS labels, 4 AS score, 5 AS size, 6 AS fingerprint, 7 AS target, 8 AS odds, 9 AS node"
    return spark.createDataFrame(rows, columns).selectExpr("*", *clash.split(", "))


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
