import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, comp long"


@pytest.fixture()
def docs_of(spark):
    """documents with extra columns whose names the operators use themselves."""

    def make(texts, ids=None, langs=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, (langs or ["en"] * len(texts))[k], (sources or ["s"] * len(texts))[k],
                 None if t is None else len(t), 9.0, "x", None) for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, DOCS)

    return make
