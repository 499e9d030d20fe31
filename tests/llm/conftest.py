import pytest

EDGE = "doc_id long, text string, lang string, n_words long, kept string, ids string"


@pytest.fixture(scope="session")
def edge_rows(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, clashing names."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron "
    rows = [(1, None, "en", 1, "x", "y"), (2, "", None, None, None, None), (3, " \n\t ", "en", 3, "x", "y"),
            (4, "one two", "en", 4, "x", "y"), (4, "one two", "en", 4, "x", "y"), (None, "one two", None, 5, "x", "y"),
            (None, None, None, None, None, None), (7, word * 20000, "en", 7, "x", "y"),
            (8, "x" * 200_000, "en", 8, "x", "y"), (9, "mail a.b@c.de or +1 (212) 555-0100, 10.0.0.1", "en", 9, "x", "y")]
    return spark.createDataFrame(rows, EDGE)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], EDGE)
