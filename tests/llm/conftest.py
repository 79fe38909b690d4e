import pytest

from fallowfunds.llm.common import small_batches


@pytest.fixture(autouse=True)
def batches(spark):
    small_batches(spark)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text[, source]) rows."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
