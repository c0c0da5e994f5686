"""The registered queries: each operator on its whole table, with the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import (
    conversations, decontaminate, fingerprints, jaccard_join, licenses, line_dedup, mixing, quality, simhash_dedup, suffix_dedup, url_filter,
    warc, whitening)
from tamis.llm.common import prepare, table, written
from tamis.llm.queries_sql import LINE_SQL, MATCH_SQL, MIX_SQL, URL_SQL, WARC_SQL

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op1_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels of the rows of the same number: bad if of low quality or toxic."""
    prepare(spark)
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = pages.select("page_id", "url").join(labels, F.col("page_id") == F.col("doc_id")).select(
        "url", bad.alias("bad"))
    return url_filter.judge(pages, outcomes, URL_RULES)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = line_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("repeats.spans", lambda s: F.concat_ws("+", s["start"], s["length"])), ",")
    return found.select("doc_id", F.col("repeats.units").cast("long").alias("n_units"), "repeats.removed_chars",
                        spans.alias("spans"), F.col("repeats.text").alias("kept_text"))


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    scored = quality.classify(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", F.col("quality_score").alias("score"), (F.col("quality_score") >= quality.THRESHOLD).alias("keep"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near`` searches for every document whose id is divisible by 20: other documents within 3 bits, copies included.

    The pairs found, by classes of equal fingerprints, are a table of their own (``op4-near``); a document's class is its
    ``fingerprint``.
    """
    prepare(spark)
    rows = written(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")), "op4")
    asked = rows.filter(F.col("doc_id") % 20 == 0)
    pairs = written(fingerprints.near_classes(asked, rows, 3), "op4-near")
    near = pairs.groupBy(F.col("query").alias("fp")).agg((F.sum("documents") - 1).alias("found"))
    near = rows.join(near, "fp", "left")
    return near.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.digits(F.col("fp")).alias("fingerprint"),
        fingerprints.digits(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        F.when(F.col("doc_id") % 20 == 0, F.col("found")).alias("n_near"))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", F.col("found.n_words"), hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op8_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_chunks(manifest, with_data=False).filter("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("repeats.spans")
    removed = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select("doc_id", "repeats.n_bytes", removed.alias("n_removed"), F.size(spans).cast("long").alias("n_spans"),
                        F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = licenses.find_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.array_join("licenses.license", ", ").alias("licenses"),
                        F.array_max("licenses.containment").alias("containment"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return conversations.report(conversations.repair(conversations.damage(table(spark, sf_dir, "conversations"))))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.similar(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_host_reputation, op2_line_dedup, op3_weak_quality, op4_fingerprints, op5_pareto_mix, op6_simhash_dedup, op7_decontaminate,
    op8_warc_roundtrip, op9_suffix_dedup, op10_license_scan, op11_whitening, op12_conversation_repair, op13_jaccard_join)}
ORACLE: dict[str, str] = {
    "op1_host_reputation": URL_SQL, "op2_line_dedup": LINE_SQL, "op5_pareto_mix": MIX_SQL,
    "op7_decontaminate": MATCH_SQL, "op8_warc_roundtrip": WARC_SQL}
