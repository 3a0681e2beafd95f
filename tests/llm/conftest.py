import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, spans string, _key long, words string, n long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, equal rows, equal ids with other texts, and columns with clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(20_000))
    rows = [
        (1, "Some plain words stand here. Mail a.b@example.com or call +1 (017) 555-7713.\nSecond line.", "en", "a", 10, 1, "x", 1, "w", 1),
        (1, "Some plain words stand here. Mail a.b@example.com or call +1 (017) 555-7713.\nSecond line.", "en", "a", 10, 1, "x", 1, "w", 1),
        (2, "", "en", "a", 0, 2, None, 2, None, 2),
        (3, None, "fr", "b", None, None, None, None, None, None),
        (4, long, "de", "b", len(long), 4, "y", 4, "w", 4),
        (None, "no id but text", None, None, None, None, None, None, None, None),
        (5, "été là où ça va bien " * 30, "fr", None, 5, 5, "z", 5, "w", 5),
        (5, "another text under the same id", "en", "c", 5, 5, "z", 5, "w", 5),
        (6, " \n\t ", None, "c", 4, 6, "z", 6, "w", 6),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
