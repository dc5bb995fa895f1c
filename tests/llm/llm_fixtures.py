"""Fixtures of these tests; a second conftest would hide that of the other tests."""

from __future__ import annotations

import pytest

from tillroll.llm.queries import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture
def docs(llm):
    def make(rows, schema="doc_id long, text string"):
        return llm.createDataFrame(rows, schema)

    return make


#: Null and empty texts and ids, ties, repeated rows, a very long text.
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "a"), (None, "a null id"), (5, "é☃😀 " * 3), (6, "word " * 40_000), (7, "x" * 100_000), (7, "other text of a repeated id")]


@pytest.fixture
def edge(docs):
    return docs(EDGE)


@pytest.fixture
def empty(docs):
    return docs([])
