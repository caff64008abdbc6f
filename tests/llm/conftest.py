import pytest

from encore.session import prepare
from tests.session import local_session

EDGES = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a", 1),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a", 1),  # a repeated row
    (2, None, None, 2),
    (3, "", "b", 3),
    (4, " \t\n ", "b", 4),
    (5, "one", None, 5),
    (6, "wörter über Straße " * 20_000, "a", 6),  # very long
    (None, "a text without a key but with words", "c", 7),
    (8, "nul \x00 bell \x07 mark \x01 <|endoftext|> \u00a0 ünï", "c", 8),
]
# Columns whose names the operators use inside, or return.
CLASHES = "score double, size long, target string, held_out string, _text string, key string, fingerprint string, rank int, count long"


@pytest.fixture(scope="session")
def spark():
    yield prepare(local_session())


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    rows = [(*r, 0.5, 9, "t", "h", "x", "k", "f", 1, 2) for r in EDGES]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, extra int, {CLASHES}")


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.filter("false")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (3, 0, 1), (5, 0, 0), (5, 1, 0), (6, 1, None), (None, 1, 1), (8, None, 1)], "doc_id long, quality int, toxic int"
    )
