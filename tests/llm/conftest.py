import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers can import the package, and know where to write."""
    from larkspur.session import shared_folder

    shared_folder(spark)


@pytest.fixture
def documents(spark):
    def make(texts, ids=None, lang=None, source=None):
        """Rows like ``documents``, from texts; ids count from 0."""
        rows = [
            (i if ids is None else ids[i], t, None if lang is None else lang[i], "s" if source is None else source[i], None if t is None else len(t))
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make
