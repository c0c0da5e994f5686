"""Partitioned layers, create-once artefacts and their manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators.checks import ContractError
from tamis.sources.files import exists

PARTITIONS = ("ingestion_date", "batch_id", "processing_run_id")
CREATED, REUSED = "CREATED", "REUSED"


def write_layer(df: DataFrame, path: str, partitions: Sequence[str] = PARTITIONS, mode: str = "append") -> None:
    """Hive-style partitions.

    The rebalance hint lets AQE merge small output files and split a partition that holds most of
    the rows over several tasks, which a plain ``repartition`` by the partition columns cannot.
    """
    df.hint("rebalance", *[F.col(p) for p in partitions]).write.partitionBy(*partitions).mode(mode).parquet(path)


def read_layer(spark: SparkSession, path: str, **partition: str) -> DataFrame:
    """One run, or all; the filters prune directories."""
    df = spark.read.parquet(path)
    for name, value in partition.items():
        df = df.filter(F.col(name) == value)
    return df


def artefact_path(root: str, contract: Mapping[str, str]) -> str:
    return (f"{root}/{contract['layer']}/batch_id={contract['batch_id']}"
            f"/processing_run_id={contract['processing_run_id']}")


def measure(df: DataFrame, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count(key).alias("unique_ids")
    )


def content_hash(df: DataFrame) -> str:
    """Action: a digest of all rows that does not depend on their order; repeated rows count."""
    row = F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).cast("decimal(38,0)")
    found = df.agg(F.count(F.lit(1)), F.sum(row), F.sum(F.abs(row % 1000003) * 31)).first()
    return "-".join(str(v or 0) for v in found)


def _manifest(stored: DataFrame, contract: Mapping[str, str], key: str, manifests: str) -> None:
    row = measure(stored, key).select(*[F.lit(v).alias(n) for n, v in contract.items()], "*")
    row.write.mode("append").parquet(manifests)


def write_once(df: DataFrame, root: str, contract: Mapping[str, str], key: str) -> tuple[str, DataFrame]:
    """Writes one artefact unless it is there, and returns (outcome, artefact).

    ``contract`` names layer, batch_id, processing_run_id, schema_version and parent, and may hold the parent's content
    hash. An artefact that is there must carry the same contract, and still hold the rows and ids its manifest says;
    anything else is an error, never an overwrite. A run that died between artefact and manifest left complete data
    (``_SUCCESS``) that no manifest speaks for: the manifest is then written from the stored rows.
    """
    spark = df.sparkSession
    path, manifests = artefact_path(root, contract), f"{root}/manifests"
    same_run = [F.col(c) == contract[c] for c in ("layer", "batch_id", "processing_run_id")]
    if not exists(spark, path):
        df.write.mode("errorifexists").parquet(path)
        stored = spark.read.parquet(path)
        _manifest(stored, contract, key, manifests)
        return CREATED, stored
    if not exists(spark, f"{path}/_SUCCESS"):
        raise ContractError(f"unfinished artefact: {path}")
    stored = spark.read.parquet(path)

    def manifest() -> DataFrame:
        known = spark.read.option("mergeSchema", True).parquet(manifests)
        for condition in same_run:
            known = known.filter(condition)
        return known

    if not exists(spark, manifests) or manifest().isEmpty():
        _manifest(stored, contract, key, manifests)
    known = manifest()
    found = measure(stored, key).select(F.col("row_count").alias("_rows"), F.col("unique_ids").alias("_ids"))
    # At most one manifest row per run: a one-row driver read.
    rows = known.crossJoin(found).limit(2).collect()
    if len(rows) != 1:
        raise ContractError(f"{len(rows)} manifests for {path}")
    wrong = [n for n, v in contract.items() if rows[0][n] != v]
    wrong += [n for n, m in (("row_count", "_rows"), ("unique_ids", "_ids")) if rows[0][n] != rows[0][m]]
    if wrong:
        raise ContractError(f"artefact differs from its contract in {', '.join(wrong)}: {path}")
    return REUSED, stored


def write_report(metrics: DataFrame, path: str) -> None:
    """Rule-sized metric table as one JSON file."""
    metrics.coalesce(1).write.mode("errorifexists").json(path)
