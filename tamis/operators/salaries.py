"""Salary normalisation: a narrow projection, one row per offer with a stated salary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions import flags, salary
from tamis.functions.text import first_match
from tamis.presets import rules


def parse_label(offers: DataFrame) -> DataFrame:
    """Period, bounds and months read from the label; the period is set on every match."""
    label = F.col("salaire_libelle")
    return offers.withColumns(
        {
            "periode_extraite": salary.part(label, 1),
            "salaire_min_brut": salary.amount(label, 2),
            "_maximum": salary.amount(label, 3),
            "duree_mois_brute": salary.amount(label, 4),
        }
    ).withColumn("salaire_parse_ok", F.col("periode_extraite").isNotNull())


def complete_bounds(parsed: DataFrame) -> DataFrame:
    """A single amount is its own maximum; the period must be the one stored before."""
    low, high = F.col("salaire_min_brut"), F.col("_maximum")
    return parsed.withColumns(
        {
            "salaire_max_brut": F.when(low.isNotNull(), F.coalesce(high, low)),
            "format_salaire": F.when(
                F.col("salaire_parse_ok"),
                F.when(high.isNull(), F.lit(rules.SINGLE_AMOUNT)).otherwise(F.lit(rules.AMOUNT_RANGE)),
            ),
            "periode_salaire_coherente": flags.is_true(
                F.col("periode_extraite") == F.col("periode_salaire_normalisee")
            ),
        }
    ).drop("_maximum")


def annualise(bounded: DataFrame) -> DataFrame:
    period = F.col("periode_extraite")
    raw = F.col("salaire_min_brut"), F.col("salaire_max_brut")
    yearly = F.col("salaire_annuel_min"), F.col("salaire_annuel_max")
    return bounded.withColumns(
        {
            "salaire_annuel_min": salary.annual(period, raw[0]),
            "salaire_annuel_max": salary.annual(period, raw[1]),
            "salaire_central_brut": salary.midpoint(*raw),
        }
    ).withColumn("salaire_annuel_central", salary.midpoint(*yearly))


def qualify(annual: DataFrame, suspect_above: Decimal = rules.SUSPECT_ABOVE) -> DataFrame:
    """Outlier flag, first reason against use, and the method. Usable means: no reason found."""
    low, high = F.col("salaire_annuel_min"), F.col("salaire_annuel_max")
    period, parsed = F.col("periode_extraite"), F.col("salaire_parse_ok")
    reason, method = rules.REASONS, rules.METHODS
    checks = [
        (~parsed, "unparsed"),
        (~F.col("periode_salaire_coherente"), "incoherent"),
        (period == salary.HOURLY, "hourly"),
        (F.col("salaire_suspect"), "suspect"),
        (low.isNull() | high.isNull(), "not_annual"),
        (low <= 0, "not_positive"),
        (high < low, "reversed"),
    ]
    methods = [
        (~parsed, "unparsed"),
        (period == salary.HOURLY, "hourly"),
        (period == salary.YEARLY, "yearly"),
        (period == salary.MONTHLY, "monthly"),
    ]
    threshold = F.lit(suspect_above).cast(salary.MONEY)
    return annual.withColumns(
        {
            "seuil_salaire_annuel_suspect": threshold,
            "salaire_suspect": flags.is_true(high > threshold),
        }
    ).withColumns(
        {
            "motif_non_exploitation": first_match((c, F.lit(reason[k])) for c, k in checks),
            "methode_normalisation_salaire": first_match((c, F.lit(method[k])) for c, k in methods),
        }
    ).withColumn("salaire_exploitable", F.col("motif_non_exploitation").isNull())


def normalise(offers: DataFrame, suspect_above: Decimal = rules.SUSPECT_ABOVE) -> DataFrame:
    """One row per offer whose salary is stated."""
    stated = offers.filter(flags.is_true(F.col("salaire_renseigne")))
    return stated.transform(parse_label).transform(complete_bounds).transform(annualise).transform(
        qualify, suspect_above
    )


OUTPUT = (
    "id_offre", "intitule_offre", "famille_metier_data", "categorie_contrat",
    "categorie_temps_travail", "code_departement",
    "salaire_libelle", "periode_salaire", "periode_salaire_normalisee",
    "salaire_parse_ok", "periode_extraite", "periode_salaire_coherente",
    "salaire_min_brut", "salaire_max_brut", "salaire_central_brut", "format_salaire",
    "duree_mois_brute", "salaire_annuel_min", "salaire_annuel_max", "salaire_annuel_central",
    "methode_normalisation_salaire", "seuil_salaire_annuel_suspect", "salaire_suspect",
    "salaire_exploitable", "motif_non_exploitation",
    "batch_id", "processing_run_id", "silver_schema_version", "fichier_source_silver",
    "date_chargement",
)


def salary_table(enriched: DataFrame, suspect_above: Decimal = rules.SUSPECT_ABOVE) -> DataFrame:
    return normalise(enriched, suspect_above).select(*OUTPUT)


FACTS = (
    "salaire_parse_ok", "salaire_suspect", "salaire_exploitable", "motif_non_exploitation",
    "salaire_annuel_min", "salaire_annuel_max", "salaire_annuel_central",
)


def join_facts(enriched: DataFrame, salaries: DataFrame) -> DataFrame:
    """Offers with the facts of a stored salary table; flags of offers without one are false.

    Both sides are large, so no broadcast: sort-merge on the id, split by AQE where skewed.
    """
    joined = enriched.join(salaries.select("id_offre", *FACTS), "id_offre", "left")
    return joined.withColumns({c: flags.is_true(F.col(c)) for c in FACTS[:3]})


def attach_facts(enriched: DataFrame, suspect_above: Decimal = rules.SUSPECT_ABOVE) -> DataFrame:
    """Same columns as ``join_facts`` without any join, for offers with one row per id.

    The salary of an offer is a function of its own row, so the facts are computed in place and
    blanked where no salary is stated.
    """
    stated = flags.is_true(F.col("salaire_renseigne"))
    own = enriched.columns
    full = (
        enriched.transform(parse_label)
        .transform(complete_bounds)
        .transform(annualise)
        .transform(qualify, suspect_above)
    )
    facts = [
        (F.col(c) & stated if c in FACTS[:3] else F.when(stated, F.col(c))).alias(c) for c in FACTS
    ]
    return full.select(*own, *facts)
