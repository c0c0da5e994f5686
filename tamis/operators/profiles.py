"""Quality profiles: one aggregate per table, then long form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.functions import flags, json, rates, text
from tamis.operators import checks
from tamis.presets import rules as offer_rules


def is_missing(field: T.StructField) -> Column:
    """Null, blank text or an empty list."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text.is_blank(col)
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(col) <= 0, F.lit(True))
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.coalesce(F.isnan(col), F.lit(False))
    return col.isNull()


def _per_column(df: DataFrame, columns: Sequence[str], counters: Mapping[str, callable]) -> DataFrame:
    """``counters`` of every column from one pass: (colonne, lignes, <counter> ...)."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[make(c).alias(f"_{i}_{name}") for i, c in enumerate(columns) for name, make in counters.items()],
    )
    rows = [
        F.struct(F.lit(c).alias("colonne"), F.col("_rows").alias("lignes"),
                 *[F.col(f"_{i}_{name}").alias(name) for name in counters])
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counted = _per_column(df, columns, {"missing_count": lambda c: F.count_if(is_missing(df.schema[c]))})
    available = F.col("lignes") - F.col("missing_count")
    return counted.select(
        "colonne",
        available.alias("available_count"),
        "missing_count",
        rates.report_rate(available, F.col("lignes")).alias("completeness_rate"),
    )


def missing_ranking(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns by falling share of missing values, then in table order."""
    columns = list(columns or df.columns)
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("colonne"))
    counted = _per_column(df, columns, {"manquant": lambda c: F.count_if(is_missing(df.schema[c]))})
    present = F.col("lignes") - F.col("manquant")
    return counted.select(
        "colonne",
        "manquant",
        present.alias("present"),
        rates.report_rate(F.col("manquant"), F.col("lignes"), 0.0).alias("taux_manquant"),
        rates.report_rate(present, F.col("lignes"), 0.0).alias("taux_present"),
        order.alias("ordre"),
    ).orderBy(F.col("taux_manquant").desc(), "ordre")


def _validity(df: DataFrame, columns: Sequence[str], valid) -> DataFrame:
    """valid / invalid / missing and the rate over filled values (null if there are none)."""

    def filled(c: str) -> Column:
        return ~text.is_blank(F.col(c))

    counted = _per_column(
        df,
        columns,
        {
            "valid_count": lambda c: F.count_if(filled(c) & valid(F.col(c))),
            "missing_count": lambda c: F.count_if(~filled(c)),
        },
    )
    invalid = F.col("lignes") - F.col("valid_count") - F.col("missing_count")
    return counted.select(
        "colonne",
        "valid_count",
        invalid.alias("invalid_count"),
        "missing_count",
        rates.report_rate(F.col("valid_count"), F.col("lignes") - F.col("missing_count")).alias("validity_rate"),
    )


def json_validity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bare NaN and Infinity count as invalid: they are no JSON, though some parsers take them."""
    return _validity(df, columns, json.is_valid)


def date_validity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _validity(df, columns, lambda c: F.try_to_timestamp(text.strip(c)).isNotNull())


def invalid_json_examples(df: DataFrame, column: str, key: str, limit: int = 3) -> DataFrame:
    """The first ``limit`` bad values by key, as a report."""
    bad = ~text.is_blank(F.col(column)) & ~json.is_valid(F.col(column))
    return df.filter(bad).select(key, column).orderBy(key).limit(limit)


def date_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, gaps, first and last instant per column; a column the table lacks is listed as absent."""
    present = [c for c in columns if c in df.columns]
    kinds = {c: df.schema[c].dataType.simpleString() for c in present}
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[f(c).cast(k).alias(f"_{i}_{n}")
          for i, c in enumerate(present)
          for n, f, k in (("n", F.count, "long"), ("min", F.min, "timestamp"), ("max", F.max, "timestamp"))],
    )

    def line(c: str) -> Column:
        if c not in present:
            null = F.lit(None)
            return F.struct(F.lit(c).alias("colonne"), F.lit(False).alias("presente"),
                            null.cast("string").alias("type"), null.cast("long").alias("valeurs_manquantes"),
                            null.cast("timestamp").alias("date_min"), null.cast("timestamp").alias("date_max"))
        i = present.index(c)
        return F.struct(F.lit(c).alias("colonne"), F.lit(True).alias("presente"), F.lit(kinds[c]).alias("type"),
                        (F.col("_rows") - F.col(f"_{i}_n")).alias("valeurs_manquantes"),
                        F.col(f"_{i}_min").alias("date_min"), F.col(f"_{i}_max").alias("date_max"))

    return wide.select(F.inline(F.array(*[line(c) for c in columns])))


def distribution(df: DataFrame, column: str, missing: str = "NULL") -> DataFrame:
    """Count per value, null included; most frequent first, then by value."""
    value = F.col(column).cast("string")
    shown = F.when(text.is_blank(value), missing).otherwise(value)
    return (
        df.groupBy(shown.alias("valeur")).agg(F.count(F.lit(1)).alias("nombre"))
        .orderBy(F.col("nombre").desc(), "valeur")
    )


def top_values(df: DataFrame, column: str, limit: int = 15, missing: str = offer_rules.UNKNOWN) -> DataFrame:
    """The most frequent values as a report; null and '' carry the label ``missing``."""
    value = F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(missing))
    counted = df.groupBy(value.alias("valeur")).agg(F.count(F.lit(1)).alias("nombre"))
    return counted.orderBy(F.col("nombre").desc(), "valeur").limit(limit)


def volume_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows and columns of two layers and the difference in rows."""
    a = before.agg(F.count(F.lit(1)).alias("lignes_avant"))
    b = after.agg(F.count(F.lit(1)).alias("lignes_apres"))
    return a.crossJoin(b).select(
        "*",
        (F.col("lignes_avant") - F.col("lignes_apres")).alias("ecart_lignes"),
        F.lit(len(before.columns)).cast("long").alias("colonnes_avant"),
        F.lit(len(after.columns)).cast("long").alias("colonnes_apres"),
    )


def key_report(df: DataFrame, key: str) -> DataFrame:
    """Missing, distinct and repeated keys (null counts as one more key among the repeats)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    gone = text.is_blank(F.col(key).cast("string"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(gone, F.col("_n"))), F.lit(0)).alias("manquants"),
        F.count(key).alias("uniques"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("doublons"),
    )


def column_contract(df: DataFrame, critical: Sequence[str], computed: Sequence[str]) -> DataFrame:
    """Presence of the contract's columns, and the gaps of the critical ones."""
    present = [c for c in critical if c in df.columns]
    gaps = _per_column(df, present, {"manquant": lambda c: F.count_if(is_missing(df.schema[c]))})
    listed = df.sparkSession.createDataFrame(
        [(c, "critique", c in df.columns) for c in critical]
        + [(c, "calculee", c in df.columns) for c in computed],
        "colonne string, groupe string, presente boolean",
    )
    gaps = gaps.select("colonne", F.lit("critique").alias("groupe"), F.col("manquant").alias("valeurs_manquantes"))
    return listed.join(gaps, ["colonne", "groupe"], "left")


def presence_rates(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Count and rate of each condition in one pass."""
    names = list(tests)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(flags.is_true(t)).alias(f"_{i}") for i, t in enumerate(tests.values())],
    )
    rows = [
        F.struct(F.lit(n).alias("indicateur"), F.col(f"_{i}").alias("nombre"), F.col("_rows").alias("lignes"))
        for i, n in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*rows))).select(
        "indicateur", "nombre", rates.report_rate(F.col("nombre"), F.col("lignes"), 0.0).alias("taux")
    )


def distributions(df: DataFrame, columns: Sequence[str], missing: str = "NULL") -> DataFrame:
    """Value counts of several columns from one read: (colonne, valeur, nombre)."""
    pairs = [F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("v")) for c in columns]
    rows = df.select(F.inline(F.array(*pairs)))
    shown = F.when(text.is_blank(F.col("v")), missing).otherwise(F.col("v"))
    return rows.groupBy("colonne", shown.alias("valeur")).agg(F.count(F.lit(1)).alias("nombre"))


def silver_verdict(
    df: DataFrame, key: str, critical: Sequence[str], computed: Sequence[str],
    complete_dates: Sequence[str], json_columns: Sequence[str],
) -> DataFrame:
    """All rules of the silver report: columns, keys, dates that must be filled, readable JSON."""
    absent = checks.required_columns(df, [*critical, *computed])
    rules = {f"colonne_absente_{c}": F.lit(1) for c in absent}
    if key in df.columns:
        rules |= {"cles_manquantes": checks.missing_key(key), "cles_dupliquees": checks.duplicate_key(key)}
    rules |= {f"dates_manquantes_{c}": checks.not_null(c) for c in complete_dates if c in df.columns}
    rules |= {
        f"json_invalide_{c}": F.count_if(~text.is_blank(F.col(c)) & ~json.is_valid(F.col(c)))
        for c in json_columns if c in df.columns
    }
    return checks.long_form(df, rules)
