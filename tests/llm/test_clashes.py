"""Columns that are named like the operators' own keep their values and crash nothing."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tamis.llm import decontaminate, line_dedup, quality, suffix_dedup
from tamis.llm.common import table

NAMES = ("__o", "__x", "__X", "__units", "__rank", "__p", "__at", "__gone", "__document", "__repeats", "found", "quality_score",
         "copies", "size", "taken", "target", "__drawn", "o", "x", "t", "g", "id", "node", "unit", "bytes", "page", "map")


@pytest.fixture(scope="module", params=[False, True], ids=["ids", "ties"])
def extra(spark, request):
    text = "a first line that is long enough to stay here.\n" + " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, text), (1 if request.param else 2, text + " and more of it."), (3, "another text."), (4, None)], "doc_id long, text string")
    docs = docs.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    names = [n for n in NAMES if n != "__X"]
    return docs.select("*", *(F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names))


def kept(rows, names, renamed=lambda n: n):
    assert rows
    for row in rows:
        assert all(row[renamed(n)] == f"{n}{row['doc_id']}" for n in names), row


def test_operators_keep_them(spark, extra, small):
    names = [c for c in extra.columns if c in NAMES]
    for made in (line_dedup.remove_repeats(extra), suffix_dedup.remove_repeats(extra), quality.classify(extra, into="score"),
                 decontaminate.find_matches(extra, table(spark, small, "benchmark"), into="hits")):
        kept(made.collect(), names)
    replaced = line_dedup.remove_repeats(extra, into="found")
    assert replaced.columns.count("found") == 1 and "units" in replaced.schema["found"].dataType.fieldNames()


def test_stages_keep_them(spark, extra, small):
    names = [c for c in extra.columns if c in NAMES]
    for name, stage in corpus_pipeline.STAGES[1:]:
        made = stage(spark, extra, small)
        if name == "mixing":
            kept(made.collect(), names, lambda n: f"_{n}" if n in corpus_pipeline.MIXED else n)
            assert set(corpus_pipeline.MIXED) <= set(made.columns)
        else:
            assert made.columns == extra.columns
            kept(made.collect(), names)


def test_whole_tokens_have_a_shape():
    long = "a" * 64
    assert quality.slots(long + "1")[1] != quality.slots(long + "A")[1]
    assert quality.slots("Ab1") == quality.whole_slots("Ab1")
