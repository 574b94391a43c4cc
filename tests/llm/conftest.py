import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """(id, text) rows as a documents table with columns whose names clash
    with result columns."""
    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, row long"
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), "x", "y", 1) for i, t in rows], schema)
    return make


@pytest.fixture(scope="session")
def vectors_of(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows],
                                     "vec_id long, embedding array<float>, label int, id string, node string")
    return make
