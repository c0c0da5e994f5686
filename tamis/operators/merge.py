"""Merging overlapping acquisitions: several queries may return the same record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def no_id(col: Column) -> Column:
    """Null or empty identifier."""
    return F.coalesce(col.cast("string") == "", F.lit(True))


def unlisted(query: Column, queries: Sequence[str]) -> Column:
    return F.coalesce(~query.isin(list(queries)), F.lit(True))


def query_rank(query: Column, queries: Sequence[str]) -> Column:
    """Position of a query in the list; queries outside the list come last."""
    found = F.array_position(F.array(*[F.lit(q) for q in queries]), query)
    return F.when(found > 0, found).otherwise(F.lit(len(queries) + 1).cast("long"))


def merge_hits(
    hits: DataFrame,
    queries: Sequence[str],
    id_column: str,
    query_column: str,
    position: Sequence[str],
) -> DataFrame:
    """One row per id: payload of the first hit, and all queries that found it in their order.

    First means lowest query, then lowest ``position`` within the query. The aggregate combines
    on the map side, so an id returned millions of times travels as one row per task; the set of
    queries of an id is bounded by the list of queries.
    """
    payload = [c for c in hits.columns if c not in (id_column, query_column, *position)]
    rank = query_rank(F.col(query_column), queries)
    first = F.struct(F.col(query_column).alias("search_keyword"), *payload)
    merged = (
        hits.filter(~no_id(F.col(id_column)))
        .groupBy(id_column)
        .agg(
            F.min_by(first, F.struct(rank, *position)).alias("_first"),
            F.array_sort(F.collect_set(F.struct(rank.alias("r"), F.col(query_column).alias("q")))).alias("_found"),
        )
    )
    return merged.select(
        id_column,
        "_first.*",
        F.transform("_found", lambda x: x["q"]).alias("search_keywords"),
    )


def funnel(hits: DataFrame, queries: Sequence[str], id_column: str, query_column: str) -> DataFrame:
    """Per query of the list, in order and even without hits:

    ``resultats_api``, ``nouvelles`` (first seen here), ``deja_couvertes`` (seen in an earlier
    query), ``doublons_dans_requete``, ``sans_id``, ``nombre_couvertes`` and
    ``nombre_exclusives`` (found by this query alone).

    Hits of queries outside the list, or of none, are one more row with a null ``requete``, ranked last as in
    ``merge_hits``; without such hits it is left out.

    One counter per query and id replaces a shuffle per question; the hits without id are one
    group, which the map-side aggregate keeps small.
    """
    col = F.col(id_column)
    counters = [f"_q{i}" for i in range(len(queries) + 1)]
    by_query = [F.col(query_column) == q for q in queries] + [unlisted(F.col(query_column), queries)]
    per_id = (
        hits.groupBy(F.when(~no_id(col), col).alias("_id"))
        .agg(*[F.count_if(found).alias(c) for found, c in zip(by_query, counters)])
        .withColumn("_has_id", F.col("_id").isNotNull())
        .withColumn(
            "_first",
            F.coalesce(*[F.when(F.col(c) > 0, F.lit(i)) for i, c in enumerate(counters)]),
        )
        .withColumn("_found_by", F.expr(" + ".join(f"int({c} > 0)" for c in counters)))
    )
    totals = []
    for i, c in enumerate(counters):
        n, named = F.col(c), F.col("_has_id")
        seen = named & (n > 0)
        totals += [
            F.coalesce(F.sum(n), F.lit(0)).alias(f"{c}_resultats_api"),
            F.count_if(seen & (F.col("_first") == i)).alias(f"{c}_nouvelles"),
            F.count_if(seen & (F.col("_first") != i)).alias(f"{c}_deja_couvertes"),
            F.coalesce(F.sum(F.when(seen, n - 1)), F.lit(0)).alias(f"{c}_doublons_dans_requete"),
            F.coalesce(F.sum(F.when(~named, n)), F.lit(0)).alias(f"{c}_sans_id"),
            F.count_if(seen).alias(f"{c}_nombre_couvertes"),
            F.count_if(seen & (F.col("_found_by") == 1)).alias(f"{c}_nombre_exclusives"),
        ]
    fields = ("resultats_api", "nouvelles", "deja_couvertes", "doublons_dans_requete", "sans_id",
              "nombre_couvertes", "nombre_exclusives")
    rows = [
        F.struct(F.lit(i + 1).alias("ordre"), F.lit(q).cast("string").alias("requete"),
                 *[F.col(f"_q{i}_{f}").alias(f) for f in fields])
        for i, q in enumerate([*queries, None])
    ]
    listed = per_id.agg(*totals).select(F.inline(F.array(*rows)))
    return listed.filter(F.col("requete").isNotNull() | (F.col("resultats_api") > 0))


def coverage(merged: DataFrame, queries: Sequence[str], keywords: str = "search_keywords") -> DataFrame:
    """Covered and exclusive ids per query, from merged rows; one pass, no explode.

    Ids found by queries outside the list count in a last row with a null ``requete``, which is left out without such ids.
    """
    others = F.exists(keywords, lambda q: unlisted(q, queries))
    only = F.forall(keywords, lambda q: unlisted(q, queries))
    last = len(queries)
    counts = [F.count_if(others).alias(f"_c{last}"), F.count_if(others & only).alias(f"_e{last}")]
    for i, q in enumerate(queries):
        counts += [
            F.count_if(F.array_contains(keywords, q)).alias(f"_c{i}"),
            F.count_if(F.col(keywords) == F.array(F.lit(q))).alias(f"_e{i}"),
        ]
    rows = [
        F.struct(F.lit(q).cast("string").alias("requete"), F.col(f"_c{i}").alias("nombre_couvertes"),
                 F.col(f"_e{i}").alias("nombre_exclusives"))
        for i, q in enumerate([*queries, None])
    ]
    listed = merged.agg(*counts).select(F.inline(F.array(*rows)))
    return listed.filter(F.col("requete").isNotNull() | (F.col("nombre_couvertes") > 0))
