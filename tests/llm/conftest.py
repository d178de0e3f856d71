import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names may clash inside."""

    def make(pairs):
        found = [(i, t, "en", "src", len(t or "")) for i, t in pairs]
        frame = spark.createDataFrame(found, DOC_SCHEMA)
        return frame.selectExpr("*", "doc_id AS start", "text AS words", "lang AS part", "n_chars AS rest")

    return make
