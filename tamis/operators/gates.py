"""Gates between layers: what a layer claims is computed again and compared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import json, text
from tamis.operators import checks, cleaning
from tamis.operators.identity import digest


def differs(actual: Column, expected: Column) -> Column:
    """Null-safe inequality."""
    return ~actual.eqNullSafe(expected)


def bronze_equals_raw(raw: DataFrame, bronze: DataFrame, key: str = "id", record: str = "raw_record",
                      same: Sequence[str] = ("search_keyword", "search_keywords", "ingestion_timestamp")) -> DataFrame:
    """Record-level comparison of raw and bronze.

    ``raw`` has the id and the record text. Both sides shrink to fingerprints before the shuffle,
    and the copies of an id meet in an aggregate, not in a join. The gate needs unique ids, so
    repeats are counted as violations of their own.
    """
    def own(name: str) -> Column:
        return F.try_variant_get(F.col("_parsed"), f"$['{name}']", "string")

    def short(name: str, c: Column) -> list[Column]:
        """128 bits of a short field."""
        c = F.coalesce(c, F.lit("\x00"))
        return [F.xxhash64(c).alias(f"_{name}_h"), F.xxhash64(F.lit("tamis"), c).alias(f"_{name}_l")]

    def content() -> list[Column]:
        return [part.alias(f"_content_{half}") for half, part in digest(F.to_json("_parsed")).items()]

    # Each text is parsed once; the fields and the canonical form are read from the result.
    expected = raw.select(F.col(key).cast("string").alias("id"), F.try_parse_json("record").alias("_parsed")).select(
        "id", F.lit(0).alias("_side"), F.lit(True).alias("_readable"), F.lit(True).alias("_own_id"),
        *content(), *[c for n in same for c in short(n, own(n))],
    )
    readable = F.coalesce(json.is_valid(F.col(record)), F.lit(False))
    actual = bronze.select(
        F.col(key).cast("string").alias("id"), readable.alias("_readable"),
        F.try_parse_json(record).alias("_parsed"), *same,
    ).select(
        "id", F.lit(1).alias("_side"), "_readable",
        F.coalesce(own(key) == F.col("id"), F.lit(False)).alias("_own_id"),
        *content(), *[c for n in same for c in short(n, F.col(n))],
    )
    fields = ["content", *same]
    per_id = expected.unionByName(actual).groupBy("id").agg(
        F.count_if(F.col("_side") == 0).alias("_raw"),
        F.count_if(F.col("_side") == 1).alias("_bronze"),
        F.bool_and("_readable").alias("_readable"),
        F.bool_and("_own_id").alias("_own_id"),
        *[
            ((F.min(f"_{f}_h") == F.max(f"_{f}_h")) & (F.min(f"_{f}_l") == F.max(f"_{f}_l"))).alias(f"same_{f}")
            for f in fields
        ],
    )
    named = F.col("id").isNotNull()
    both = named & (F.col("_raw") > 0) & (F.col("_bronze") > 0)

    def unnamed(side: str) -> Column:
        return F.coalesce(F.sum(F.when(~named, F.col(side))), F.lit(0))

    rules = {
        "ids_nuls_raw": unnamed("_raw"),
        "ids_nuls_bronze": unnamed("_bronze"),
        "ids_absents_bronze": F.count_if(named & (F.col("_bronze") == 0)),
        "ids_inattendus_bronze": F.count_if(named & (F.col("_raw") == 0)),
        "ids_dupliques": F.count_if(named & ((F.col("_raw") > 1) | (F.col("_bronze") > 1))),
        "enregistrement_illisible": F.count_if(both & ~F.col("_readable")),
        "enregistrement_autre_id": F.count_if(both & F.col("_readable") & ~F.col("_own_id")),
        "enregistrement_different": F.count_if(both & F.col("_readable") & ~F.col("same_content")),
    }
    rules |= {f"{n}_different": F.count_if(both & ~F.col(f"same_{n}")) for n in same}
    return checks.long_form(per_id, rules)


def silver_equals_raw(raw: DataFrame, silver: DataFrame) -> DataFrame:
    """Record, id and keyword list of silver against raw; the primary keyword is folded there, see ``keyword_checks``."""
    kept = silver.select(F.col("id_offre").alias("id"), F.col("enregistrement_brut").alias("raw_record"),
                         F.col("mots_cles_recherche").alias("search_keywords"))
    return bronze_equals_raw(raw, kept, same=("search_keywords",))


def lineage_checks(df: DataFrame, expected: Mapping[str, object]) -> DataFrame:
    """Each lineage column holds exactly its expected value."""
    return checks.long_form(df, {f"{c}_incoherent": checks.not_single(c, v) for c, v in expected.items()})


def drift_coherent(drift: DataFrame, declared: bool, declared_fields: int) -> DataFrame:
    """The declared drift of a batch against the found one."""
    found = drift.filter(~F.col("bloquant")).select("champ").distinct().agg(F.count(F.lit(1)).alias("_n"))
    flag_ok = F.lit(declared) == (F.lit(declared_fields) > 0)
    return found.select(
        F.inline(F.array(
            F.struct(F.lit("derive_declaree").alias("controle"),
                     F.when(flag_ok, 0).otherwise(1).cast("long").alias("violations")),
            F.struct(F.lit("derive_constatee").alias("controle"),
                     F.when(F.col("_n") == declared_fields, 0).otherwise(1).cast("long").alias("violations")),
        ))
    )


def recompute(df: DataFrame, expected: Mapping[str, Column], three_valued: Sequence[str] = ()) -> DataFrame:
    """Stored indicators against their recomputed values, in one pass.

    An indicator must not be null unless it is ``three_valued``; then null must meet null.
    """
    rules = {}
    for name, value in expected.items():
        if name not in three_valued:
            rules[f"{name}_nul"] = F.count_if(F.col(name).isNull())
            rules[f"{name}_incoherent"] = F.count_if(F.col(name).isNotNull() & differs(F.col(name), value))
        else:
            rules[f"{name}_incoherent"] = F.count_if(differs(F.col(name), value))
    return checks.long_form(df, rules)


def silver_indicators(df: DataFrame) -> DataFrame:
    return recompute(df, cleaning.indicators(), ("date_actualisation_coherente", "periode_salaire"))


def normalised_keyword(col: Column) -> Column:
    return F.lower(text.clean(col))


def keyword_checks(df: DataFrame, primary: str = "mot_cle_recherche", listed: str = "mots_cles_recherche") -> DataFrame:
    """The primary keyword belongs to the list, compared after trimming and case folding."""
    words = F.from_json(F.col(listed), "array<string>")
    readable = F.coalesce(F.size(words) > 0, F.lit(False))
    folded = F.transform(words, normalised_keyword)
    member = F.coalesce(F.array_contains(folded, normalised_keyword(F.col(primary))), F.lit(False))
    return checks.long_form(
        df,
        {
            "liste_invalide": F.count_if(~readable),
            "mot_cle_hors_liste": F.count_if(readable & ~member),
        },
    )


def technical_dates(df: DataFrame, columns: Sequence[str] = ("date_ingestion", "date_traitement_silver")) -> DataFrame:
    return checks.long_form(df, {f"{c}_non_unique": checks.not_single(c) for c in columns})


def load_matrix(
    metrics: DataFrame, summary: DataFrame, ids: DataFrame, schema: Mapping[str, object],
    audit: DataFrame, expected: Mapping[str, object], staging_left: bool,
) -> DataFrame:
    """The 31 named checks of a serving load as (controle, ok).

    ``metrics`` is ``identity.target_metrics`` over the snapshot, ``summary`` the row comparison,
    ``ids`` the layer identity of source and target, ``audit`` at most one run row. All of them
    are one-row or rule-sized frames.
    """
    keys = {name: F.lit(value) for name, value in expected.items()}
    rows = keys["rows"]
    incomplete = ids.filter(F.col("controle") == "ids_incomplets").select(F.col("violations").alias("_ids"))
    run = audit.select(F.struct("*").alias("_audit"), F.lit(1).alias("_one"))
    base = metrics.crossJoin(summary.select(F.col("contenu_identique").alias("_content"))).crossJoin(incomplete)
    base = base.withColumn("_one", F.lit(1)).join(run, "_one", "left")
    a = {f.name: F.col(f"_audit.{f.name}") for f in audit.schema}
    exists = F.col("_audit").isNotNull()

    def single(column: str) -> Column:
        return F.col(f"nombre_{column}") == 1

    def equal(column: str) -> Column:
        return F.col(f"{column}_min").eqNullSafe(keys[column])

    ok = {
        "silver_non_vide": rows > 0,
        "nombre_lignes_identique": F.col("nombre_lignes") == rows,
        "ids_distincts_identiques": F.col("ids_distincts") == rows,
        "ids_non_nuls": F.col("ids_manquants") == 0,
        "ids_non_dupliques": F.col("ids_dupliques") == 0,
        "ensembles_ids_identiques": F.col("_ids") == 0,
        "schema_valide": F.lit(bool(schema["schema_valide"])),
        "batch_unique": single("batch_id"),
        "batch_id_identique": equal("batch_id"),
        "processing_run_unique": single("processing_run_id"),
        "processing_run_id_identique": equal("processing_run_id"),
        "silver_schema_version_unique": single("silver_schema_version"),
        "silver_schema_version_identique": equal("silver_schema_version"),
        "source_silver_unique": single("fichier_source_silver"),
        "source_silver_identique": equal("fichier_source_silver"),
        "date_chargement_non_nulle": F.col("date_chargement_manquants") == 0,
        "date_chargement_unique": single("date_chargement"),
        "contenu_identique": F.col("_content"),
        "audit_present": exists,
        "audit_success": a["status"] == "SUCCESS",
        "audit_batch_id_identique": a["batch_id"] == keys["batch_id"],
        "audit_processing_run_identique": a["processing_run_id"] == keys["processing_run_id"],
        "audit_source_object_identique": a["source_object_key"] == keys["fichier_source_silver"],
        "audit_sha256_identique": a["source_sha256"] == keys["source_sha256"],
        "audit_volume_source_identique": a["source_row_count"] == rows,
        "audit_volume_charge_identique": a["loaded_row_count"] == rows,
        "audit_schema_version_identique": a["silver_schema_version"] == keys["silver_schema_version"],
        "audit_git_commit_present": F.length(a["git_commit_sha"]) > 0,
        "audit_git_branch_presente": F.length(a["git_branch"]) > 0,
        "audit_git_worktree_clean": ~a["git_worktree_dirty"],
        "table_intermediaire_absente": F.lit(not staging_left),
    }
    lines = [
        F.struct(F.lit(n).alias("controle"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in ok.items()
    ]
    return base.select(F.inline(F.array(*lines)))


def load_status(matrix: DataFrame) -> DataFrame:
    return matrix.agg(
        F.when(F.bool_and("ok"), "VALIDE").otherwise("NON_VALIDE").alias("statut"),
        F.count_if("ok").alias("controles_valides"),
        F.count(F.lit(1)).alias("controles"),
    )
