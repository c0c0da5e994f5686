"""Area reference: many-to-one join, checks, and attachment to facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.text import strip
from tamis.presets import areas as preset
from tamis.presets import rules


def _constant(spark: SparkSession, rows: Sequence[Sequence[str]], columns: str) -> DataFrame:
    """A table of constants inside the plan, whose size the optimiser knows."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "\\'") + "'"

    lines = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {lines} as t({columns})")


def preset_areas(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Area and region tables of the preset (101 and 18 rows)."""
    return (
        _constant(spark, preset.AREAS, "code_departement, nom_departement, code_region"),
        _constant(spark, preset.REGIONS, "code_region, nom_region"),
    )


def preset_reference(spark: SparkSession) -> DataFrame:
    """The preset areas with the name of their region, as constants."""
    region = dict(preset.REGIONS)
    rows = [(code, name, key, region[key]) for code, name, key in preset.AREAS]
    return _constant(spark, rows, "code_departement, nom_departement, code_region, nom_region")


def many_to_one(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join that fails when a key occurs twice on the right.

    The check rides along in the aggregate that makes the right side unique. Whether that side is broadcast is left to
    Spark, which knows its bytes at run time; a shuffled join is split where a key is frequent.
    """
    others = [c for c in right.columns if c != on]
    row = F.struct(*others) if others else F.struct(F.col(on))
    unique = right.groupBy(on).agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_row"))
    message = F.concat(F.lit("key occurs more than once: "), F.col(on).cast("string"))
    checked = unique.select(
        on,
        F.when(F.col("_n") > 1, F.raise_error(message).cast(unique.schema["_row"].dataType))
        .otherwise(F.col("_row"))
        .alias("_row"),
    )
    return left.join(checked, on, "left").select(*left.columns, *[F.col(f"_row.{c}") for c in others])


def build_reference(areas: DataFrame, regions: DataFrame) -> DataFrame:
    """Areas with the name of their region, trimmed and sorted by code."""
    joined = many_to_one(areas, regions, "code_region")
    columns = ("code_departement", "nom_departement", "code_region", "nom_region")
    return joined.select(*[strip(F.col(c)).alias(c) for c in columns]).orderBy("code_departement")


def reference_problems(reference: DataFrame) -> DataFrame:
    """One row per rule with the number of offending rows."""
    columns = reference.columns
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_manquants") for c in columns]
    key = columns[0]
    doubles = (F.count(key) - F.count_distinct(F.col(key))).alias(f"{key}_dupliques")
    wide = reference.agg(*counts, doubles)
    return wide.unpivot([], wide.columns, "controle", "violations")


def attach_area(offers: DataFrame, reference: DataFrame) -> DataFrame:
    """Region columns and display values for unknown areas.

    The reference has one row per area code. Spark broadcasts it if its bytes are below the session's threshold; the
    preset is part of the plan, so its size is known beforehand.
    """
    known = reference.select(
        F.col("code_departement"),
        F.col("nom_departement").alias("_area"),
        F.col("code_region").alias("_region"),
        F.col("nom_region").alias("_region_name"),
    )
    return offers.join(known, "code_departement", "left").select(
        *offers.columns,
        F.coalesce("code_departement", F.lit(rules.NO_AREA)).alias("code_departement_mart"),
        F.coalesce("_area", F.lit(rules.UNKNOWN)).alias("nom_departement_mart"),
        F.coalesce("_region", F.lit(rules.NO_REGION)).alias("code_region_mart"),
        F.coalesce("_region_name", F.lit(rules.UNKNOWN)).alias("nom_region_mart"),
    )
