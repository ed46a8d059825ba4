"""Small tables with the odd cases that every operator has to stand."""

import pytest

LONG = "word other third " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows and ids, clashing names."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "a"),
        (2, "ALPHA beta gamma delta epsilon zeta eta theta", "b"),
        (2, "ALPHA beta gamma delta epsilon zeta eta theta", "b"),
        (3, None, None),
        (4, "", "c"),
        (5, " \n\t ", "d"),
        (6, LONG, "e"),
        (7, LONG + "end", "e"),
        (8, "two words", "f"),
        (9, "Two Words", "f"),
        (None, "no id here at all", "g"),
        (10, "mail a.b@example.org or +49 30 1234 56789, card 4111 1111 1111 1111, ip 10.0.0.1", "h"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string").selectExpr(
        "*", "'x' as node", "1 as n", "'y' as row", "2 as digest", "'z' as group", "0 as id"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
