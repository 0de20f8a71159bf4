import pytest

from tideline.llm.shipping import ship

#: Rows every operator must take: nulls, empty and long texts, ties, and repeated rows.
ODD_TEXTS = [None, "", " ", "\n\n", "a", "é" * 40, "word " * 3000, "x" * 50_000]


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    ship(spark)


@pytest.fixture()
def docs_of(spark):
    """Documents (doc_id, text) with further columns, some named like an operator's own."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "found", 1.5, "x") for i, t in zip(ids, texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, found string, score double, bucket string"
        )

    return make


@pytest.fixture()
def odd_docs(docs_of):
    return docs_of([*ODD_TEXTS, *ODD_TEXTS[:3]], [*range(len(ODD_TEXTS)), 0, 1, None])
