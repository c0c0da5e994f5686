"""Seconds per headline query; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` set input and cores. Every query runs once to
warm up and is then timed; results go to the noop sink, so nothing is collected. The enriched layer, the salary facts and
the combined rows are tables that the marts read; writing each is timed on its own input, after one warm-up run on sf0.001.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
os.environ.setdefault("PYSPARK_DRIVER_PYTHON", sys.executable)

from tamis.plans import catalogue, tables  # noqa: E402
from tamis.session import build_session  # noqa: E402

HEADLINE = (
    "enrich_all", "salary_normalise", "mart_market_kpis", "mart_by_family", "mart_by_contract", "mart_by_area",
    "mart_by_region", "mart_salary_analysis", "conditional_distinct_counts", "exact_quantiles",
    "merge_acquisitions", "merge_funnel", "bronze_flatten", "bronze_schema_drift", "raw_gate", "silver_layer",
    "bronze_gate", "silver_gate", "salary_attach", "compare_rows_summary", "layer_identity", "id_reconciliation",
    "profile_completeness", "profile_json_validity", "classify_documents",
)
RUNS = 2


def seconds(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("tamis-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tamis-"),
        "spark.tamis.inputPartitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    tables.prepare(spark)

    def layers(folder: str) -> dict[str, float]:
        return {
            "write_enriched_layer": seconds(lambda: tables.enriched(spark, folder)),
            "write_salary_layer": seconds(lambda: tables.salary_layer(spark, folder)),
            "write_salary_facts": seconds(lambda: tables.salary_facts(spark, folder)),
            "write_combined_rows": seconds(lambda: tables.combined(spark, folder)),
        }

    layers(os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    timings = layers(sf_dir)
    for name in HEADLINE:
        def run(query=catalogue.QUERIES[name]):
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = min(seconds(run) for _ in range(RUNS))
    spark.stop()
    rounded = {name: round(value, 3) for name, value in timings.items()}
    print(json.dumps({
        "metric": "headline queries, total seconds (best of %d after warm-up)" % RUNS,
        "value": round(sum(timings.values()), 3), "unit": "sec", "queries": rounded,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    with contextlib.redirect_stderr(open(os.devnull, "w")) if os.environ.get("BENCH_QUIET") else contextlib.nullcontext():
        main()
