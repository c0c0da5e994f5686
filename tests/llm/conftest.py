import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from tamis.llm.common import prepare  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def rows(small):
    """The small documents as a list of (id, text)."""
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{small}/documents.parquet' order by 1").fetchall()


@pytest.fixture(scope="session")
def make(spark):
    """Documents with columns of clashing names besides their own."""

    def build(pairs, source="s"):
        data = [(i, t, "en", source, len(t) if t is not None else None, 1, "x", 2.5) for i, t in pairs]
        return spark.createDataFrame(data, DOCS + ", size int, fingerprint string, o double")

    return build


@pytest.fixture(scope="session")
def odd(make):
    """Null ids and texts, empty and blank texts, ties, repeated rows and one long text."""
    long = " ".join(f"word{i % 700} runs" for i in range(60000))
    return make([(1, None), (2, ""), (3, " \n\t "), (None, "no id here"), (None, None), (4, "same text here, twice."),
                 (4, "same text here, twice."), (4, "another text with the same id"), (5, "same text here, twice."),
                 (6, long), (7, "one"), (-3, "two words")])


@pytest.fixture(scope="session")
def none(make):
    return make([])
