"""Name -> query and, where SQL can say the same, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamis.plans import tables
from tamis.session import ensure_scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_scratch(spark)
        tables.prepare(spark)
        return tables.plain(query(spark, sf_dir))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql
