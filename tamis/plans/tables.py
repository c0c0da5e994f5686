"""Reading the provided tables, and layers written once per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.operators import dimension, enrichment, marts, salaries
from tamis.plans import offers_sql
from tamis.session import scratch_path

_LAYERS: dict[tuple[str, str, str], str | marts.Combined] = {}

# SQL settings that may be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JIT compiler skips methods above 8000 bytes of byte code; such stages run faster as
    # separately generated expressions than as one huge generated method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession) -> None:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Set by callers that want a certain number.
INPUT_PARTITIONS = "spark.tamis.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """The scan in as many partitions as the caller's session asks for, or as there are cores.

    A compact table of millions of rows is few splits, while a derived record has many times the bytes and the work of its row.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    if wanted:
        return df.repartition(int(wanted))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def plain(df: DataFrame, drop: tuple[str, ...] = ("date_calcul_kpi",)) -> DataFrame:
    """Types every engine prints alike: decimals as double, dates and instants as text."""
    out = []
    for field in df.schema:
        if field.name in drop:
            continue
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            col = col.cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("long")
        out.append(col.alias(field.name))
    return df.select(*out)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped offers derived from orders, customer and documents."""
    prepare(spark)
    inputs = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "documents")}
    inputs["orders"] = spread(inputs["orders"])
    text = offers_sql.SILVER.replace("{offers}", offers_sql.OFFERS)
    df = spark.sql(text, **inputs)
    return df.withColumns(
        {
            "date_creation": F.col("date_creation").cast("timestamp"),
            "date_actualisation": F.col("date_actualisation").cast("timestamp"),
            "latitude": F.col("latitude").cast("double"),
            "longitude": F.col("longitude").cast("double"),
        }
    )


def stored(spark: SparkSession, sf_dir: str, layer: str, build) -> DataFrame:
    """A layer as a table below the shared folder, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _LAYERS:
        path = scratch_path(spark, layer)
        build().write.parquet(path)
        _LAYERS[key] = path
    return spark.read.parquet(_LAYERS[key])


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched layer, stored because six marts read it; long texts are searched once."""
    prepare(spark)
    return stored(
        spark, sf_dir, "enriched",
        lambda: enrichment.enrich(offers(spark, sf_dir)).drop("description_offre"),
    )


def salary_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normalised salaries, stored like the enriched layer."""
    return stored(
        spark, sf_dir, "salaries", lambda: salaries.salary_table(enriched(spark, sf_dir))
    )


def salary_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers with their salary facts and areas: labels are parsed once, and no large join is needed."""
    facts = stored(spark, sf_dir, "salary_facts", lambda: salaries.attach_facts(enriched(spark, sf_dir)))
    return dimension.attach_area(facts, dimension.preset_reference(spark))


def combined(spark: SparkSession, sf_dir: str) -> marts.Combined:
    """The rows all six marts read, stored with ids in buckets."""
    key = (spark.sparkContext.applicationId, sf_dir, "combined")
    if key not in _LAYERS:
        rows = marts.combine(salary_facts(spark, sf_dir), buckets=marts.buckets_of(spark))
        _LAYERS[key] = marts.store(rows, scratch_path(spark, "combined"))
    return _LAYERS[key]


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.attach_area(enriched(spark, sf_dir), dimension.preset_reference(spark))
