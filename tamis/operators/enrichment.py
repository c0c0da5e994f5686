"""Offer enrichment: one narrow projection over the staging columns, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions import dates, flags, place, text
from tamis.presets import rules, silver


def staging(serving: DataFrame) -> DataFrame:
    """The stable 64-column projection the later layers read."""
    return serving.select(*silver.STAGING)


def with_analysis_text(offers: DataFrame) -> DataFrame:
    """Lower-cased text the keyword rules look at."""
    parts = ("intitule_offre", "description_offre", "libelle_rome", "libelle_appellation")
    return offers.withColumn("texte_analyse_offre", F.lower(text.joined(*[F.col(p) for p in parts])))


def with_dates(offers: DataFrame, recent_days: int = rules.RECENT_DAYS) -> DataFrame:
    created, updated = F.col("date_creation"), F.col("date_actualisation")
    reference = F.col("date_reference_analyse")
    return offers.withColumn(
        "date_reference_analyse",
        dates.reference_date(F.col("date_ingestion"), F.col("date_chargement")),
    ).withColumns(
        {
            "anciennete_offre_jours": dates.days_between(created, reference),
            "delai_actualisation_jours": dates.days_between(created, updated),
            "est_offre_recente_30j": dates.within_days(created, reference, recent_days),
        }
    )


def with_area(offers: DataFrame) -> DataFrame:
    return offers.withColumn(
        "code_departement",
        place.area_code(F.col("code_commune"), F.col("code_postal"), F.col("libelle_lieu_travail")),
    )


def with_statuses(offers: DataFrame, statuses=rules.STATUSES) -> DataFrame:
    return offers.withColumns(
        {name: flags.status(F.col(flag), yes, no) for flag, (name, yes, no) in statuses.items()}
    )


def with_contract(offers: DataFrame, contracts=rules.CONTRACTS) -> DataFrame:
    """The apprenticeship flag outranks the contract code."""
    code = F.col("code_type_contrat")
    cases = [(flags.is_true(F.col("est_alternance")), F.lit(rules.APPRENTICESHIP))]
    cases += [(code.isin(*codes), F.lit(label)) for label, codes in contracts]
    cases += [(code.isNull(), F.lit(rules.UNKNOWN))]
    return offers.withColumn("categorie_contrat", text.first_match(cases, rules.OTHER))


def with_experience(offers: DataFrame, categories=rules.EXPERIENCE) -> DataFrame:
    """Substring rules, so the ``an`` of "sans" also counts as a number of years."""
    label = F.lower("libelle_experience")
    cases = [(label.isNull(), F.lit(rules.UNKNOWN))]
    cases += [(text.contains_any(label, needles), F.lit(name)) for name, needles in categories]
    return offers.withColumn("categorie_experience", text.first_match(cases, rules.OTHER))


def with_working_time(offers: DataFrame, categories=rules.WORKING_TIME) -> DataFrame:
    parts = F.col("libelle_duree_travail"), F.col("libelle_duree_travail_converti")
    label = F.lower(text.joined(*parts))
    cases = [(text.contains_any(label, needles), F.lit(name)) for name, needles in categories]
    cases += [(~flags.any_present(*parts), F.lit(rules.UNKNOWN))]
    return offers.withColumn("categorie_temps_travail", text.first_match(cases, rules.OTHER))


def with_family(
    offers: DataFrame,
    families=rules.FAMILIES,
    other: str = rules.OTHER_FAMILY,
    column: str = "texte_analyse_offre",
) -> DataFrame:
    return offers.withColumn("famille_metier_data", text.classify(F.col(column), families, other))


def with_technologies(
    offers: DataFrame, technologies=rules.TECHNOLOGIES, column: str = "texte_analyse_offre"
) -> DataFrame:
    """The list is computed once; the flag only asks whether it is empty, so the text is not searched twice."""
    return offers.withColumn(
        "technologies_cloud_devops_detectees", text.label_list(F.col(column), technologies)
    ).withColumn("mention_cloud_devops", F.col("technologies_cloud_devops_detectees").isNotNull())


def with_salary_period(offers: DataFrame) -> DataFrame:
    return offers.withColumn(
        "periode_salaire_normalisee", F.coalesce("periode_salaire", F.lit(rules.UNKNOWN_PERIOD))
    )


def with_sector(offers: DataFrame) -> DataFrame:
    return offers.withColumn(
        "secteur_activite_renseigne",
        flags.any_present(F.col("code_secteur_activite"), F.col("libelle_secteur_activite")),
    )


def with_completeness(offers: DataFrame, classes=rules.COMPLETENESS) -> DataFrame:
    """Score 0-8 and its class."""
    tests = [
        F.col(c).isNotNull()
        for c in ("id_offre", "intitule_offre", "description_offre", "code_type_contrat", "code_rome")
    ]
    tests += [
        F.col(c)
        for c in ("localisation_renseignee", "information_entreprise_disponible", "salaire_renseigne")
    ]
    total = F.col("score_qualite_offre")
    cases = [(total >= lowest, F.lit(label)) for label, lowest in classes]
    return offers.withColumn("score_qualite_offre", flags.score(*tests)).withColumn(
        "categorie_qualite_offre", text.first_match(cases, rules.INCOMPLETE)
    )


STEPS = (
    with_analysis_text,
    with_dates,
    with_area,
    with_statuses,
    with_contract,
    with_experience,
    with_family,
    with_technologies,
    with_salary_period,
    with_working_time,
    with_sector,
    with_completeness,
)


def enrich(offers: DataFrame) -> DataFrame:
    """All enrichment columns. Steps nobody reads are pruned by Catalyst."""
    for step in STEPS:
        offers = offers.transform(step)
    return offers.drop("texte_analyse_offre")
