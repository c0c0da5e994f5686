"""Design choices measured against the plain form, on the provided lineitem table.

usage: python tools/ablation.py [sf_dir] [copies]   (copies multiplies the rows, with new order keys)
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tamis.operators import aggregates  # noqa: E402
from tamis.session import build_session, scratch_path  # noqa: E402

KEYS = ["l_returnflag"]
QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def timed(name: str, make) -> None:
    times = []
    for _ in range(3):
        started = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    print(f"{name:45s} {min(times[1:]):7.2f}s", flush=True)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "16", "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tamis-"),
        "spark.tamis.inputPartitions": "8",
                                                "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_path(spark, "ablation")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines.crossJoin(spark.range(copies)).withColumn(
        "l_orderkey", F.col("l_orderkey") * copies + F.col("id")
    ).drop("id").repartition(16).write.parquet(path)
    df = spark.read.parquet(path)
    print(f"{df.count()} rows")

    conditions = {f"c{i}": F.col("l_quantity") > i * 2 for i in range(20)}
    timed("20 conditional distinct counts, plain", lambda: df.groupBy(*KEYS).agg(
        *[F.count_distinct(F.when(c, F.col("l_orderkey"))).alias(n) for n, c in conditions.items()]))
    timed("20 conditional distinct counts, one mask",
          lambda: aggregates.distinct_counts(df, KEYS, "l_orderkey", conditions))

    cents = df.withColumn("centimes", F.round(F.col("l_extendedprice") * 100).cast("long"))
    timed("exact quartiles, percentile()", lambda: cents.groupBy(*KEYS).agg(
        F.percentile("centimes", F.array(*[F.lit(q) for q in QUANTILES.values()]))))
    timed("exact quartiles, counted buckets",
          lambda: aggregates.exact_quantiles(cents, KEYS, "centimes", QUANTILES, bucket=10000.0))

    axes = ("l_returnflag", "l_linestatus", "l_linenumber")

    def union():
        parts = [df.select(F.lit(a).alias("axe"), F.col(a).cast("string").alias("v"), "l_orderkey") for a in axes]
        parts.append(df.select(F.lit("global").alias("axe"), F.lit("x").alias("v"), "l_orderkey"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.groupBy("axe", "v").agg(F.count_distinct("l_orderkey"))

    def unpivot(rows):
        pairs = [F.struct(F.lit(a).alias("axe"), F.col(a).cast("string").alias("v")) for a in axes]
        pairs.append(F.struct(F.lit("global").alias("axe"), F.lit("x").alias("v")))
        return rows.select("*", F.inline(F.array(*pairs))).drop(*axes)

    timed("four axes, union of four reads", union)
    timed("four axes, unpivot then count", lambda: aggregates.distinct_counts(
        unpivot(df.select("l_orderkey", *axes)), ["axe", "v"], "l_orderkey", {}))
    spark.stop()


if __name__ == "__main__":
    main()
