import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, source); n_chars from the text."""
    def made(rows, extra=""):
        full = [(r[0], r[1], "en", r[2], None if r[1] is None else len(r[1]), *r[3:]) for r in rows]
        return spark.createDataFrame(full, DOCS + extra)
    return made
