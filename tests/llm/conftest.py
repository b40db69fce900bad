import pytest


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs."""

    def make(rows, columns="doc_id long, text string"):
        return spark.createDataFrame(list(rows), columns)

    return make
