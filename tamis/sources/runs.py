"""Audit log of loads, and state of pipeline runs and metrics from append-only events.

Events are appended, never updated; the state of a key is an aggregate over its events. Two
writers can append at the same time, and a replayed event changes nothing. ``metric_table`` and
``audit_table`` store that state itself, so that a read does not aggregate the whole history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.rates import report_rate
from tamis.operators.checks import ContractError
from tamis.sources.keyed import KeyedTable


# Layers and units a metric may carry.
LAYERS = ("RAW", "BRONZE", "SILVER", "POSTGRES", "DBT")
UNITS = ("count", "percent", "boolean")
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
BUILD_TASK = "dbt_build"


def append(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def latest(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last event per key. ``max_by`` combines on the map side; no window over a hot key."""
    rest = [c for c in events.columns if c not in keys]
    picked = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return picked.select(*keys, "_last.*")


def audit_state(events: DataFrame) -> DataFrame:
    """One row per run: start from its first event, outcome from its last."""
    outcome = latest(events.drop("started_at"), ["run_id"], ["sequence"])
    started = events.groupBy("run_id").agg(F.min("started_at").alias("started_at"))
    return outcome.join(started, "run_id")


def latest_matching(audit: DataFrame, context: Mapping[str, str]) -> DataFrame:
    """The highest run that matches all values, at most one row."""
    found = audit
    for name, value in context.items():
        found = found.filter(F.col(name) == value)
    return found.orderBy(F.col("run_id").desc()).limit(1)


def run_state(events: DataFrame, keys: Sequence[str] = ("dag_id", "dag_run_id")) -> DataFrame:
    """State per run from events (kind RUNNING, SUCCESS or FAILED, ``sequence``, ``at``).

    A restart keeps the earliest start and forgets the outcome; the end sets the duration. A
    failure of the build task marks the build as failed.
    """
    at = F.col("at").cast("timestamp")
    started = F.min(F.when(F.col("kind") == RUNNING, at)).alias("started_at")
    last = F.max_by(F.struct("kind", at.alias("at"), "failed_task_id", "error_message"), "sequence").alias("_last")
    state = events.groupBy(*keys).agg(started, last)
    ended = F.col("_last.kind") != RUNNING
    failed = F.col("_last.kind") == FAILED
    finished = F.when(ended, F.col("_last.at"))
    seconds = F.unix_micros(finished) - F.unix_micros("started_at")
    return state.select(
        *keys,
        F.col("_last.kind").alias("status"),
        "started_at",
        finished.alias("finished_at"),
        (seconds / 1e6).alias("duration_seconds"),
        F.when(failed, F.col("_last.failed_task_id")).alias("failed_task_id"),
        F.when(failed, F.col("_last.error_message")).alias("error_message"),
        F.when(F.col("_last.kind") == SUCCESS, SUCCESS)
        .when(failed & (F.col("_last.failed_task_id") == BUILD_TASK), FAILED)
        .alias("dbt_status"),
    )


def normalise_metrics(metrics: DataFrame) -> DataFrame:
    """Trimmed names, upper-case layer, lower-case unit."""
    return metrics.withColumns(
        {
            "layer": F.upper(F.trim("layer")),
            "metric_name": F.trim("metric_name"),
            "metric_unit": F.lower(F.trim("metric_unit")),
            "source_task_id": F.trim("source_task_id"),
        }
    )


def metric_problem(value: str = "metric_value") -> Column:
    """First broken rule of a normalised metric row, null if it may be stored."""
    v, unit = F.col(value).cast("double"), F.col("metric_unit")

    def empty(name: str) -> Column:
        return F.coalesce(F.col(name) == "", F.lit(True))

    return (
        F.when(~F.coalesce(F.col("layer").isin(*LAYERS), F.lit(False)), "layer")
        .when(empty("metric_name"), "metric_name")
        .when(~F.coalesce(unit.isin(*UNITS), F.lit(False)), "metric_unit")
        .when(empty("source_task_id"), "source_task_id")
        .when(v.isNull(), "metric_value")
        .when((unit == "boolean") & ~v.isin(0.0, 1.0), "boolean")
        .when((unit == "count") & ((v < 0) | (v != F.floor(v))), "count")
        .when((unit == "percent") & ((v < 0) | (v > 100)), "percent")
    )


def metric_checks(metrics: DataFrame) -> DataFrame:
    """Number of metrics per broken rule."""
    return (
        normalise_metrics(metrics).select(metric_problem().alias("controle"))
        .filter(F.col("controle").isNotNull()).groupBy("controle")
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def metric_state(
    metrics: DataFrame, keys: Sequence[str] = ("pipeline_run_id", "layer", "metric_name"), order: str = "sequence"
) -> DataFrame:
    """Stored value per (run, layer, metric): the last one written wins."""
    valid = normalise_metrics(metrics).filter(metric_problem().isNull())
    return latest(valid, list(keys), [order])


def metric_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """Stored metrics, unique by (run, layer, metric)."""
    return KeyedTable(spark, root, ("pipeline_run_id", "layer", "metric_name"), ("sequence",), buckets=buckets)


def store_metrics(table: KeyedTable, metrics: DataFrame) -> int:
    """Merges normalised metrics into the stored ones; nothing is stored if any row breaks a rule."""
    rows = normalise_metrics(metrics)
    broken = rows.select(metric_problem().alias("p")).filter("p is not null").groupBy("p").count().collect()
    if broken:  # a row per rule
        raise ContractError(", ".join(f"{r['p']}: {r['count']}" for r in sorted(broken)))
    return table.upsert(rows)


def audit_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """Stored runs, unique by run: the outcome of the last event, the earliest start of all."""
    return KeyedTable(spark, root, ("run_id",), ("sequence",), ("started_at",), buckets)


def run_metrics(layers: Mapping[str, DataFrame], key: str, drift: DataFrame, rates: Mapping[str, str],
                build_ok: bool) -> DataFrame:
    """The 15 figures a finished run reports, as (layer, metric_name, metric_value, metric_unit).

    ``layers``: raw, bronze, silver and serving frames; ``rates``: metric name -> silver flag.
    """
    def line(layer: str, name: str, value: Column, unit: str) -> Column:
        return F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("metric_name"),
                        value.cast("double").alias("metric_value"), F.lit(unit).alias("metric_unit"))

    def rows_of(df: DataFrame, lines: Sequence[Column]) -> DataFrame:
        return df.select(F.inline(F.array(*lines)))

    def counted(df: DataFrame, id_column: str) -> DataFrame:
        return df.groupBy(id_column).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.count(id_column).alias("_ids"))

    def shape(layer: str, df: DataFrame, id_column: str) -> DataFrame:
        return rows_of(counted(df, id_column), [
            line(layer, "row_count", F.col("_rows"), "count"),
            line(layer, "unique_id_count", F.col("_ids"), "count"),
            line(layer, "column_count", F.lit(len(df.columns)), "count"),
        ])

    raw, bronze, silver, serving = (layers[n] for n in ("raw", "bronze", "silver", "serving"))
    n = F.count(F.lit(1))
    fields = drift.filter(~F.col("bloquant")).agg(F.count_distinct("champ").alias("_n"))
    shares = silver.agg(n.alias("_rows"), *[F.count_if(F.col(c)).alias(m) for m, c in rates.items()])
    parts = [
        rows_of(raw.agg(n.alias("_n")), [line("RAW", "row_count", F.col("_n"), "count")]),
        shape("BRONZE", bronze, "id"),
        rows_of(fields, [
            line("BRONZE", "schema_drift_field_count", F.col("_n"), "count"),
            line("BRONZE", "schema_drift_detected", (F.col("_n") > 0).cast("int"), "boolean"),
        ]),
        shape("SILVER", silver, key),
        rows_of(shares, [
            line("SILVER", m, report_rate(F.col(m), F.col("_rows"), 0.0), "percent")
            for m in rates
        ]),
        rows_of(serving.agg(n.alias("_n")), [
            line("POSTGRES", "row_count", F.col("_n"), "count"),
            line("DBT", "build_success", F.lit(int(build_ok)), "boolean"),
        ]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Rate metric -> silver flag.
RATE_METRICS = {
    "localisation_pct": "localisation_renseignee",
    "coordinates_pct": "coordonnees_renseignees",
    "salary_available_pct": "salaire_renseigne",
    "company_information_pct": "information_entreprise_disponible",
}

__all__ = ["RATE_METRICS", "append", "audit_state", "audit_table", "latest", "latest_matching", "metric_checks",
           "metric_problem", "metric_state", "metric_table", "normalise_metrics", "run_metrics", "run_state", "store_metrics"]
