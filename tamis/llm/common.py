"""Shared helpers: tables, written intermediate results, and batches of text as byte arrays."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.session import ensure_scratch, scratch_path

# Settings every query of this subpackage relies on; all may be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Rows and bytes per Arrow batch: some MB of text, so that a Python worker never holds much more.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    ensure_scratch(spark)
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    # Python workers import this package from where the driver found it, if it is not installed.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table below ``spark.checkpoint.dir``: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Gives freed memory of a Python worker back, which lives on for later tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def text_hash(text) -> F.Column:
    """Identity of a text inside its row key; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one UTF-8 array and the n + 1 offsets into it; null is empty."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def pieces(texts: pa.Array, limit: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of a batch of at most ``limit`` bytes each; a longer text is a slice of its own."""
    sizes = np.diff(byte_view(texts)[1])
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield texts.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(texts):
        yield texts.slice(start)


# Bytes are mapped to random odd 64-bit values, so that regular texts cannot cancel out in sums.
_VALUES = np.random.RandomState(20240229).randint(0, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i up to n."""
    if len(_POWERS[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all of their bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Rolling:
    """Hash of any slice of an array of small values or 64-bit hashes, in constant time each."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values))
        terms = _VALUES[values] if values.dtype == np.uint8 else values
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(terms * up[:len(values)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.raw(start, end))


def free(name: str, columns: Iterable[str]) -> str:
    """``name`` with as many underscores in front as it takes to be none of the columns, upper and lower case alike."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(docs: DataFrame, id_col: str, text_col: str, into: str) -> tuple[DataFrame, bool]:
    """``docs`` with a long ``into`` that orders documents by id, null ids last, and whether no two rows share it for sure.

    Unique ids are that number themselves. Otherwise rows get their rank by (id, hash of the text), so rows that share an
    id are told apart, and only rows that repeat id and text share a number. ``into`` must not be a column of ``docs``.
    """
    seen = docs.groupBy(F.col(id_col).alias("id")).count().filter("count > 1 or id is null")
    if seen.isEmpty():
        return docs.withColumn(into, F.col(id_col).cast("long")), True
    keys = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("o"),
                       text_hash(F.col(text_col)).alias("x")).distinct()
    ranged = keys.repartitionByRange("o", "x").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sizes = ranged.groupBy("part").count()  # one row per range
    before = F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("o", "x"))
    o, x, rank = (free(name, docs.columns) for name in ("__o", "__x", "__rank"))
    ranks = ranged.join(sizes, "part").select(
        F.col("o").alias(o), F.col("x").alias(x), (F.col("before") + place).alias(rank))
    met = (F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)) == F.col(o)) & (
        text_hash(F.col(text_col)) == F.col(x))
    return docs.join(ranks, met).select(*(F.col(f"`{c}`") for c in docs.columns), F.col(rank).alias(into)), False
