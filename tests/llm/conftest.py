import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` int, terms string, fp int"

LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows and ids, and
    extra columns with names that the operators use themselves."""
    rows = [
        (1, "the cat sat on the mat and looked at the dog in the yard", "en", "a", 56, 1, "x", 1),
        (2, "the cat sat on the mat and looked at the dog in the yard", "en", "b", 56, 1, "x", 1),
        (3, "", "en", "a", 0, 2, None, None),
        (4, None, "en", "a", None, 2, None, None),
        (5, " \n\t ", None, None, None, None, None, None),
        (None, "no id here but words enough for a shingle", None, "c", None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (7, LONG, "en", "a", len(LONG), 3, "y", 2),
        (8, LONG + " tail", "en", "b", None, 3, "y", 2),
        (9, "x", "fr", "", 1, 4, "z", 3),
        (9, "x", "fr", "", 1, 4, "z", 3),
        (9, "déjà vu 𝒳 ünï", "fr", "b", 13, 4, "z", 3),
        (10, "THE Cat SAT", "en", "é", 11, 5, "z", 3),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
