import pytest
from textcases import edited, prose, table


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and white texts, ties, repeated rows, short texts, copies, edited copies, a very long text."""
    base = prose(1, 300)
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "Word", "en", None),
        (5, "two words", "de", "b"), (6, "é ñ ü — 你好 x\u001cy", "fr", "b"), (None, "no id " + prose(2, 40), "en", "a"),
        (None, None, None, None), (7, base, "en", "a"), (7, base, "en", "a"), (8, base, "en", "b"),
        (9, edited(base, 3, 60), "en", "a"), (10, edited(base, 4, 60), "en", "c"), (11, prose(5, 200), "en", "a"),
        (12, prose(6, 60_000), "en", "a"), (13, "ha " * 5_000, "en", "a"), (14, "", "en", "a"),
        (15, "x" * 70_000, "en", "a"), (16, prose(6, 60_000), "en", "b"),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return table(spark, edge_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])
