import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of documents with columns that clash with the operators' own names."""
    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "x", 1, "y", 2.5, 0, 0, [1], "z") for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "component string, size int, key string, score double, h int, at int, "
                                           "runs array<int>, rules string")
    return make
