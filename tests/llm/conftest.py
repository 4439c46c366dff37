import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, n int, key string, label int"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from (doc_id, text[, source]); the extra columns clash with names inside operators."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, 1, 2, "k", 3) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
