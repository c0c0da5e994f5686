"""Registered queries against their SQL."""

import compare
import pytest

import __spark_entry__ as entry
from tamis.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, small, name):
    ok, message, _ = compare.compare(spark, compare.connect(small), name, small)
    assert ok, message


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
