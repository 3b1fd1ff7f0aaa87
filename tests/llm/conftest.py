import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, digest string, `_row` string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with extra columns whose names clash with those that operators make."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", len(t or ""), -1, "x", "y", "z") for i, t, lang in rows], SCHEMA)

    return make


ODD = [
    (1, "the cat sat on the mat and the dog of it", "en"),
    (2, " the cat sat on the mat\nand the dog of it", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, " \t\n", None),
    (6, "der hund und die katze von dem haus", "de"),
    (6, "der hund und die katze von dem haus", "de"),
    (7, "lang " * 30_000 + "é end", "en"),
    (None, "no id here", None),
    (8, "123 456 !!!", "en"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([]).limit(0)
