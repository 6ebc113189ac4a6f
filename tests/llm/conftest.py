import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs."""

    def make(pairs, partitions=3):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(partitions)

    return make
