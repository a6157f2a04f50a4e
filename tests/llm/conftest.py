import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents from texts, ids in order unless given."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, DOCS)

    return make
