import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Small documents tables: rows of (doc_id, text), with columns whose names clash with the operators' own."""

    def make(rows):
        rows = [(i, t, "en", "src", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, t int")

    return make
