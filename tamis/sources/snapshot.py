"""Serving snapshot: exactly one batch and run at a time, replaced atomically.

Every load writes its own version folder. A small file in the version log, made only if no file of its number exists,
publishes it, so a reader sees the old or the new snapshot and never a mix, and of two loads that want the same number one
wins; the other takes the next number, on top of the winner's columns. A load that dies leaves a folder nobody refers to,
or an empty log file, which readers pass over. Nothing is renamed or overwritten. The file system must make files
atomically if absent, as HDFS and object stores with conditional writes do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import checks, cleaning
from tamis.sources.files import exists

TRIES = 20


def align(df: DataFrame, target: DataFrame) -> DataFrame:
    """Target columns first; missing ones as nulls, new ones added, none dropped."""
    return target.limit(0).unionByName(df, allowMissingColumns=True)


def _file(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Numbers in the version log, latest first, and whether each is published; the log has one file per load."""
    if not exists(spark, f"{root}/versions_log"):
        return []
    system, target = _file(spark, f"{root}/versions_log")
    found = [(s.getPath().getName(), s.getLen()) for s in system.listStatus(target)]
    return sorted(((int(name), size > 0) for name, size in found if name.isdigit()), reverse=True)


def _number_path(root: str, version: int) -> str:
    return f"{root}/versions_log/{version:012d}"


def _claim(spark: SparkSession, path: str, content: str) -> bool:
    """Makes the file with this content; false if there is one already."""
    system, target = _file(spark, path)
    try:
        out = system.create(target, False)
        out.write(bytearray(content.encode()))
        out.close()
    except Py4JJavaError:
        if system.exists(target):
            return False
        raise
    return True


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and folder of the published snapshot."""
    for version, published in _versions(spark, root):
        if published:
            return version, spark.read.text(_number_path(root, version)).first()["value"]
    return None


def current_path(spark: SparkSession, root: str) -> str | None:
    last = current_version(spark, root)
    return last[1] if last else None


def current(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_path(spark, root)
    return spark.read.parquet(path) if path else None


def replace(
    df: DataFrame, root: str, key: str, single: Mapping[str, object | None] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Stage, validate what was written, publish; returns the new snapshot.

    If another load publishes first, this one reads the log again, writes its staged rows once more only if the winner
    brought columns they lack, and takes the next number. It gives up after ``TRIES`` lost races.
    """
    spark = df.sparkSession
    staged, path = df, None
    for _ in range(TRIES):
        version = next((v for v, _ in _versions(spark, root)), 0)
        base = current(spark, root)
        aligned = staged if base is None else align(staged, base)
        if path is None or aligned.columns != staged.columns:
            path = f"{root}/versions/{uuid.uuid4().hex}"
            aligned.write.mode("errorifexists").parquet(path)
            staged = spark.read.parquet(path)
            checks.assert_none(cleaning.load_checks(staged, key, single, required))
        if _claim(spark, _number_path(root, version + 1), path):
            return staged
    raise checks.ContractError(f"{TRIES} other loads were published first")


def already_loaded(
    audit: DataFrame, target: DataFrame, context: Mapping[str, str], expected_rows: int, key: str,
    lineage: Sequence[str] = ("batch_id", "processing_run_id"),
) -> DataFrame:
    """One row: is this content loaded, successfully, and still exactly what the target holds?"""
    run = audit.filter(F.col("status") == "SUCCESS")
    for name, value in context.items():
        run = run.filter(F.col(name) == value)
    logged = run.agg((F.count(F.lit(1)) > 0).alias("_logged"))
    wanted = [F.min(c).eqNullSafe(F.lit(context[c])) & F.max(c).eqNullSafe(F.lit(context[c])) for c in lineage]
    same = F.lit(True)
    for w in wanted:
        same = same & w
    state = target.agg((F.count(F.lit(1)) == expected_rows).alias("_rows"), same.alias("_lineage"))
    ids = target.select(key).distinct().agg((F.count(key) == expected_rows).alias("_ids"))
    state = state.crossJoin(ids)
    return logged.crossJoin(state).select(
        F.col("_logged").alias("execution_reussie"),
        (F.col("_rows") & F.col("_ids") & F.col("_lineage")).alias("cible_identique"),
        (F.col("_logged") & F.col("_rows") & F.col("_ids") & F.col("_lineage")).alias("deja_charge"),
    )
