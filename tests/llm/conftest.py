import pytest


@pytest.fixture
def docs(spark):
    """Documents with columns that clash with the operators' own."""

    def build(*texts, first=0, ids=None):
        ids = ids or range(first, first + len(texts))
        rows = [(i, t, "x", 1, "k", 5) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, "doc_id long, text string, TEXT string, size int, _range string, n_words int")

    return build
