import pytest


@pytest.fixture
def docs_of(spark):
    """Documents from ``(doc_id, text)`` rows, with columns whose names clash
    with those that the operators use inside."""
    def make(rows):
        rows = [(i, t, "en", "src0", 7, "x", 1.5) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, h double")
    return make
