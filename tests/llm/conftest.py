import pytest

from tidewatt.llm.common import shipped


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    shipped(spark)


@pytest.fixture(scope="session")
def frame(spark):
    """A table of documents from (doc_id, text) pairs, with columns that clash with inner names."""

    def build(rows, extra=True):
        schema = "doc_id long, text string, id string, row string, node string, key string, score string"
        if not extra:
            return spark.createDataFrame(rows, "doc_id long, text string")
        return spark.createDataFrame([(i, t, None, "x", "y", "z", None) for i, t in rows], schema)

    return build


@pytest.fixture(scope="session")
def sample(spark, small):
    """All documents of the smallest tables, as (doc_id, text)."""
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
