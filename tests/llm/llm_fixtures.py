import pytest

LONG = "word and another, again. " * 8000


@pytest.fixture
def texts(spark):
    """A table of documents with awkward rows, and columns whose names operators use themselves."""

    def make(*values, first=0):
        rows = [(first + i, v, "x", i, "y") for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, score string, n_words int, v string")

    return make


@pytest.fixture
def awkward(spark):
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, LONG), (6, "same text here twice"), (6, "same text here twice"),
        (7, "same text here twice"), (None, "a row without a key"), (8, "é ü 日本語 🙂 \x00 ok"), (None, None),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")
