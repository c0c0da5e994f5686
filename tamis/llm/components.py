"""Connected components of a graph given as an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``) but the roots; the root is the smallest node.

    Large star: a node sends its larger neighbours to its smallest. Small star: a node sends its smaller neighbours and
    itself to the smallest. Both keep the components and turn every one into a star in few rounds. The rows of a node
    with many neighbours are only combined by ``min`` and met by a join, never gathered; each round is written.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges, seen = written(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(smallest.select("u", F.col("m").alias("v")))
        edges = written(small.filter("u != v").distinct(), "edges")
