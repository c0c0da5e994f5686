"""Mixing sources to target weights by Pareto order sampling (built-in functions only).

Every document of a source is expected ``target / source size`` times. The whole part of that number is allocated to
each document for certain. The fraction is its inclusion probability p in a fixed-size sample: documents are ranked by
random odds over inclusion odds, u / (1 - u) : p / (1 - p), and taken in that order while words remain.

The sample is fixed in words. The document at the end is taken if that brings the source closer to its target, so a
source misses its target by half a document at most. A source may hold any share of the rows: words are first counted
per interval of the order value, the interval in which the sample ends is found from those counts, and only its rows are
ranked one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import WORD, written

INTERVALS = 1 << 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the document and the seed alone."""
    parts = (F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source (``source``, ``source_size``): adds ``target``.

    Targets share ``share`` of all words by weight and stop at ``most`` times the source's size; what is above is
    shared again by weight. That ends at min(cap, level * weight) for one level. Sources reach their cap in the order of
    cap / weight; running sums give the level if just those before a source were capped. It rises as long as too few
    are taken for capped and falls once too many are, so the largest is the one.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(1))
    order = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (order + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "budget": F.sum("source_size").over(everything) * F.lit(float(share)),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    level = (F.col("budget") - F.col("capped")) / F.col("left")
    ranked = ranked.withColumn("level", F.max(level).over(everything))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row.

    Null texts have size 0 and are never drawn for a fraction of words that is not there; null sources are a source of
    their own, the last one. Rows that repeat id and text have the same order value and are drawn one by one. An empty
    table gives no rows, and a corpus without any word targets of 0.
    """
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
        uniform(F.col(id_col), text, seed).alias("u"),
    )
    rows = written(rows, "mix-sizes")  # the long texts are read and counted once
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, share, most).select(F.col("source").alias("of"), "source_size", "target")

    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = rows.join(goal, rows["source"].eqNullSafe(F.col("of")), "left").drop("of")
    placed = placed.withColumn("certain", F.floor(expected))
    placed = placed.withColumns({
        "p": expected - F.col("certain"),
        "rest": F.col("target") - F.col("certain") * F.col("source_size"),
    })
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    placed = placed.withColumn("odds", F.when(F.col("p") > 0, odds))
    # odds / (1 + odds) runs from 0 to 1 in the same order.
    placed = placed.withColumn("interval", F.floor(F.col("odds") / (1 + F.col("odds")) * INTERVALS))

    drawn = placed.filter(F.col("odds").isNotNull())
    counted = drawn.groupBy("source", "interval").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = F.sum("words").over(W.partitionBy("source").orderBy("interval"))
    ends = counted.withColumn("upto", running).withColumn("before", F.col("upto") - F.col("words"))
    ends = ends.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(
        F.min(F.struct("interval", "before")).alias("end"))
    ends = ends.select(F.col("source").alias("of"), F.col("end.interval").alias("last"), F.col("end.before").alias("before"))

    placed = placed.join(ends, placed["source"].eqNullSafe(F.col("of")), "left").drop("of")
    at_end = F.col("interval") == F.col("last")
    inside = placed.filter(at_end)
    order = W.partitionBy("source").orderBy("odds", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    inside = inside.withColumn("so_far", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    inside = inside.withColumn("extra", (F.col("so_far") + F.col("size") / 2.0 <= F.col("rest")).cast("long"))
    outside = placed.filter(~F.coalesce(at_end, F.lit(False)))
    early = F.col("odds").isNotNull() & (F.col("last").isNull() | (F.col("interval") < F.col("last")))
    outside = outside.withColumn("extra", early.cast("long"))

    shape = ("doc_id", "source", "size", "source_size", "target", (F.col("certain") + F.col("extra")).alias("copies"))
    out = inside.select(*shape).unionByName(outside.select(*shape))
    return out.withColumn("taken", F.col("copies") * F.col("size"))
