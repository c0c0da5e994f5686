"""Bronze to silver: names, text, dates, flags and types. Narrow, except for the key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.functions import dates, flags, salary, text
from tamis.operators import checks
from tamis.presets import acquisition, silver


def rename(df: DataFrame, names: Mapping[str, str] = silver.RENAMES, drop: Sequence[str] = silver.DROPPED) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed({a: b for a, b in names.items() if a != b})


def clean_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every text column stripped of Unicode white space; blank becomes null; case is kept."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: text.clean(F.col(n)) for n in names})


def lower_keyword(df: DataFrame, column: str = "mot_cle_recherche") -> DataFrame:
    return df.withColumn(column, F.lower(column)) if column in df.columns else df


def parse_dates(
    df: DataFrame,
    iso: Sequence[str] = ("date_creation", "date_actualisation"),
    stamped: Sequence[str] = ("date_ingestion",),
) -> DataFrame:
    parsed = {c: dates.to_instant(F.col(c)) for c in iso}
    parsed |= {c: dates.to_instant(F.col(c), dates.INGESTION_FORMAT) for c in stamped}
    return df.withColumns(parsed)


def date_coherence(created: str = "date_creation", updated: str = "date_actualisation") -> Column:
    return dates.not_before(F.col(updated), F.col(created))


def company_flags(name: str = "nom_entreprise", about: str = "description_entreprise") -> dict[str, Column]:
    return {
        "entreprise_renseignee": flags.present(F.col(name)),
        "description_entreprise_renseignee": flags.present(F.col(about)),
        "information_entreprise_disponible": flags.any_present(F.col(name), F.col(about)),
    }


def salary_flags(label: str = "salaire_libelle") -> dict[str, Column]:
    return {
        "salaire_renseigne": flags.present(F.col(label)),
        "periode_salaire": salary.period_of(F.col(label)),
    }


def location_flags(
    latitude: str = "latitude",
    longitude: str = "longitude",
    others: Sequence[str] = ("libelle_lieu_travail", "code_commune", "code_postal"),
) -> dict[str, Column]:
    gps = flags.present(F.col(latitude), F.col(longitude))
    return {
        "coordonnees_renseignees": gps,
        "localisation_renseignee": gps | flags.any_present(*[F.col(c) for c in others]),
    }


def indicators() -> dict[str, Column]:
    """All computed silver columns."""
    return {
        "date_actualisation_coherente": date_coherence(),
        **company_flags(),
        **salary_flags(),
        **location_flags(),
    }


def final_types(
    df: DataFrame,
    booleans: Sequence[str] = silver.SOURCE_BOOLEANS,
    longs: Sequence[str] = silver.LONGS,
    doubles: Sequence[str] = silver.DOUBLES,
    key: str = "id_offre",
) -> DataFrame:
    """Declared types. A boolean with an unknown spelling fails the job."""
    typed = {key: F.col(key).cast("string")}
    typed |= {c: F.col(c).cast("long") for c in longs}
    typed |= {c: F.col(c).cast("double") for c in doubles}
    typed |= {
        c: F.col(c) if isinstance(df.schema[c].dataType, T.BooleanType) else flags.to_boolean(F.col(c))
        for c in booleans
    }
    return df.withColumns(typed)


def to_silver(
    bronze: DataFrame,
    processing_run_id: str,
    bronze_key: str,
    processed_at: Column | None = None,
    version: str = acquisition.SILVER_VERSION,
) -> DataFrame:
    """The whole layer as one projection over bronze."""
    checks.assert_columns(bronze, silver.RENAMES)
    df = bronze.transform(rename).transform(clean_text).transform(lower_keyword).transform(parse_dates)
    df = df.withColumns(indicators()).withColumns(
        {
            "processing_run_id": F.lit(processing_run_id),
            "silver_schema_version": F.lit(version),
            "objet_source_bronze": F.lit(bronze_key),
            "date_traitement_silver": processed_at if processed_at is not None else F.current_timestamp(),
        }
    )
    return final_types(df)


def key_checks(df: DataFrame, key: str) -> DataFrame:
    return checks.long_form(df, {"cles_manquantes": checks.missing_key(key)}, {"cles_dupliquees": key})


def layer_metrics(df: DataFrame, total: str = "lignes") -> DataFrame:
    """Headline counts of a silver table in one row."""
    counted = ("localisation_renseignee", "coordonnees_renseignees", "salaire_renseigne",
               "information_entreprise_disponible")
    return df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(flags.is_true(F.col(c))).alias(c) for c in counted]
    )


# Serving


def lenient(col: Column, kind: str) -> Column:
    """Value of the wanted type, or null where it cannot be read; NaN becomes null."""
    value = col.try_cast(kind)
    if kind == "boolean":
        # Only the two words; the cast would also take t, y, 1 and the like.
        return F.when(F.lower(F.trim(col.cast("string"))).isin("true", "false"), value)
    return F.when(~F.isnan(value), value) if kind == "double" else value


def coercion_rejects(
    df: DataFrame, booleans: Sequence[str] = (*silver.SOURCE_BOOLEANS, *silver.COMPUTED_BOOLEANS)
) -> DataFrame:
    """Filled booleans that the serving load cannot read; a load must not go on with any."""
    rules = {f"{c}_illisible": F.count_if(F.col(c).isNotNull() & lenient(F.col(c), "boolean").isNull())
             for c in booleans if c in df.columns}
    return checks.long_form(df, rules)


def serving_types(
    df: DataFrame,
    source_key: str | Column,
    loaded_at: Column | None = None,
    instants: Sequence[str] = silver.INSTANTS,
    booleans: Sequence[str] = (*silver.SOURCE_BOOLEANS, *silver.COMPUTED_BOOLEANS),
    longs: Sequence[str] = silver.LONGS,
    doubles: Sequence[str] = silver.DOUBLES,
) -> DataFrame:
    """Coercions of the serving load: nothing fails, nested values become JSON text."""
    df = df.withColumns(
        {
            "date_chargement": loaded_at if loaded_at is not None else F.current_timestamp(),
            "fichier_source_silver": source_key if isinstance(source_key, Column) else F.lit(source_key),
        }
    )
    wanted = {
        **dict.fromkeys(instants, "timestamp"), **dict.fromkeys(booleans, "boolean"),
        **dict.fromkeys(longs, "long"), **dict.fromkeys(doubles, "double"),
    }
    out = {}
    for f in df.schema:
        nested = isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        if nested:
            out[f.name] = F.to_json(F.col(f.name), {"ignoreNullFields": "false"})
        elif f.name in wanted:
            out[f.name] = lenient(F.col(f.name), wanted[f.name])
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = lenient(F.col(f.name), "double")
    return df.withColumns(out)


def load_checks(df: DataFrame, key: str = "id_offre", single: Mapping[str, object | None] | None = None,
                required: Sequence[str] = ()) -> DataFrame:
    """Contract before the load: required columns, rows, unique keys, single-valued lineage."""
    single = single or {"batch_id": None, "processing_run_id": None, "silver_schema_version": None}
    checks.assert_columns(df, [key])
    rules = {
        "colonnes_absentes": F.lit(len(checks.required_columns(df, [*required, *single]))) + F.count(F.lit(1)) * 0,
        "table_vide": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0),
        "cles_manquantes": checks.missing_key(key),
    }
    rules |= {f"{c}_non_unique": checks.not_single(c, v) for c, v in single.items() if c in df.columns}
    return checks.long_form(df, rules, {"cles_dupliquees": key})
