import pytest

from rollmill.llm.base import prepare


@pytest.fixture(scope="session")
def corpus(spark):
    """The test session, set up for corpus operators."""
    return prepare(spark)


# Rows every operator must stand: nulls, empty and blank texts, repeats, ties and a very long text.
ODD_ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, "One two three.", "b"),
    (4, "One two three.", "b"),
    (5, "One two three.", "b"),
    (5, "Another text under the same id, of seven more words.", "c"),
    (None, "No id at all, but some text!", "c"),
    (None, None, None),
    (6, "word " * 60_000, "d"),
    (7, "été <|endoftext|> a b \x1c c 's", "d"),
]


@pytest.fixture
def odd(corpus):
    """Odd rows, with columns whose names operators like to use themselves."""
    rows = [(i, t, s, 1, "x", 2.0) for i, t, s in ODD_ROWS]
    schema = "doc_id long, text string, source string, made int, version string, toxicity double"
    return corpus.createDataFrame(rows, schema)


@pytest.fixture
def nothing(corpus):
    return corpus.createDataFrame([], "doc_id long, text string, source string")
