"""One batch from acquired records to marts, with a gate after every layer.

Each layer is written once and read back by the next, so a lost executor costs the recomputation
of one layer at most, and a replay of the same run reuses what is there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.operators import bronze, checks, cleaning, dimension, enrichment, gates, identity, marts, salaries
from tamis.presets import acquisition, silver
from tamis.session import scratch_path
from tamis.sources import lake, snapshot


@dataclass(frozen=True)
class Run:
    """Names of one batch and one execution."""

    root: str
    batch_id: str
    run_id: str
    source_file: str
    ingested_at: str

    def contract(self, layer: str, version: str, parent: str, parent_hash: str = "") -> dict[str, str]:
        return {"layer": layer, "batch_id": self.batch_id, "processing_run_id": self.run_id,
                "schema_version": version, "parent": parent, "parent_hash": parent_hash}


def _once(df: DataFrame) -> DataFrame:
    """A small result over all records that several steps read, as a table, so that it is computed once."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "drift")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def to_bronze(records: DataFrame, run: Run, queries=acquisition.SEARCH_QUERIES) -> DataFrame:
    """Raw gate, drift report, flattening with undeclared fields, create-once write, bronze gate."""
    parsed = bronze.parse(records)
    checks.assert_none(bronze.record_checks(parsed, queries))
    drift = _once(bronze.schema_drift(parsed))
    blocked = drift.filter("bloquant").select(
        F.concat(F.lit("type_"), "champ").alias("controle"), F.col("enregistrements").alias("violations"))
    checks.assert_none(blocked)
    report = f"{run.root}/drift/{run.batch_id}/{run.run_id}"
    drift.coalesce(1).write.mode("overwrite").json(report)  # warnings stay on record
    flat = bronze.with_lineage(
        bronze.flatten(parsed.select("record", bronze.VALUE), extra=bronze.undeclared(parsed)),
        run.batch_id, run.run_id, run.source_file, run.source_file)
    contract = run.contract("bronze", acquisition.BRONZE_VERSION, run.source_file, lake.content_hash(records))
    _, stored = lake.write_once(flat, run.root, contract, "id")
    raw = parsed.select(bronze.field("id").alias("id"), "record")
    checks.assert_none(gates.bronze_equals_raw(raw, stored))
    checks.assert_none(gates.lineage_checks(stored, {
        "batch_id": run.batch_id, "processing_run_id": run.run_id,
        "bronze_schema_version": acquisition.BRONZE_VERSION}))
    return stored


def to_silver(bronze_table: DataFrame, run: Run, processed_at: Column) -> DataFrame:
    """Cleaning, create-once write, non-loss check, silver gate."""
    parent = lake.artefact_path(run.root, run.contract("bronze", "", ""))
    df = cleaning.to_silver(bronze_table, run.run_id, parent, processed_at)
    contract = run.contract("silver", acquisition.SILVER_VERSION, parent, lake.content_hash(bronze_table))
    _, stored = lake.write_once(df, run.root, contract, "id_offre")
    raw = bronze_table.select("id", F.col("raw_record").alias("record"))
    found = identity.non_loss((bronze_table, "id"), (stored, "id_offre"))
    for gate in (gates.silver_indicators, gates.keyword_checks, gates.technical_dates, cleaning.coercion_rejects):
        found = found.unionByName(gate(stored))
    checks.assert_none(found.unionByName(gates.silver_equals_raw(raw, stored)))  # one job for all rules
    return stored


def to_serving(silver_table: DataFrame, run: Run, loaded_at: Column) -> DataFrame:
    """Coercion, snapshot replacement, row-level comparison with silver."""
    key = lake.artefact_path(run.root, run.contract("silver", "", ""))
    served = snapshot.replace(
        cleaning.serving_types(silver_table, key, loaded_at), f"{run.root}/serving", "id_offre",
        {"batch_id": run.batch_id, "processing_run_id": run.run_id,
         "silver_schema_version": acquisition.SILVER_VERSION}, silver.REQUIRED_FOR_LOAD)
    compared = identity.compare_rows(silver_table, served, "id_offre", silver_table.columns)
    different = compared.filter("statut <> 'identique'").groupBy(F.col("statut").alias("controle")).agg(
        F.count(F.lit(1)).alias("violations"))
    checks.assert_none(different)
    return served


def build_marts(served: DataFrame, reference: DataFrame, run: Run) -> dict[str, DataFrame]:
    """Enriched offers and salary facts as tables, then the six marts on them."""
    spark, folder = served.sparkSession, f"{run.root}/marts/{run.batch_id}/{run.run_id}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    offers = stored(enrichment.enrich(enrichment.staging(served)), "offres_enrichies")
    priced = stored(salaries.attach_facts(offers.drop("description_offre")), "salaires")
    facts = dimension.attach_area(priced, reference)
    combined = marts.store(marts.combine(facts, buckets=marts.buckets_of(spark)), f"{folder}/combined")
    return {
        "marche": stored(marts.market_kpis(combined), "marche"),
        "famille": marts.by_family(combined),
        "contrat": marts.by_contract(combined),
        "departement": marts.by_area(combined),
        "region": marts.by_region(combined),
        "salaires": marts.salary_analysis(facts, combined=combined),
    }


def refine(records: DataFrame, reference: DataFrame, run: Run, queries=acquisition.SEARCH_QUERIES,
           loaded_at: Column | None = None) -> dict[str, DataFrame]:
    """All layers of one run; fails at the first gate that finds a violation."""
    at = loaded_at if loaded_at is not None else F.lit(run.ingested_at).cast("timestamp")
    bronze_table = to_bronze(records, run, queries)
    served = to_serving(to_silver(bronze_table, run, at), run, at)
    return build_marts(served, reference, run)
