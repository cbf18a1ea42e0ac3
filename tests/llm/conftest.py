import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from a list of texts, with the other columns filled in."""

    def make(texts, ids=None, **columns):
        rows = [(i if ids is None else ids[k], t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(enumerate(texts))]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
