import pytest

AWKWARD = "doc_id long, text string, lang string, spans string, score double, source string"


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns whose names clash with outputs."""
    long_text = "reach me at someone@mail.example.com or idle words go on and on\n" * 4000
    rows = [
        (1, "A line of plain words.\nAnother line of words.", "en", "x", 1.0, "s"),
        (1, "A line of plain words.\nAnother line of words.", "en", "x", 1.0, "s"),
        (2, None, None, None, None, None),
        (3, "", "en", None, None, None),
        (None, "no id here", None, None, None, None),
        (4, long_text, "en", "x", 0.5, "s"),
        (5, "\n\n \t\n", "en", "x", 0.5, "s"),
    ]
    return spark.createDataFrame(rows, AWKWARD)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], AWKWARD)
