"""Enrichment, salary and mart queries over the derived offers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.operators import dimension, enrichment, marts, salaries
from tamis.plans import oracle_sql as sql
from tamis.plans import tables
from tamis.plans.registry import register

AGES = ("date_reference_analyse", "anciennete_offre_jours", "delai_actualisation_jours",
        "est_offre_recente_30j")


def _step(name: str, step, columns: tuple[str, ...], select: str, before=None) -> None:
    """One enrichment step over all offers."""

    def query(spark, sf_dir):
        df = tables.offers(spark, sf_dir)
        for earlier in before or ():
            df = df.transform(earlier)
        return df.transform(step).select("id_offre", *columns)

    register(name, query, f"select id_offre, {select} from ({sql.ENRICHED})")


_text = (enrichment.with_analysis_text,)
register(
    "enrich_analysis_text",
    lambda spark, d: tables.offers(spark, d).transform(enrichment.with_analysis_text)
    .select("id_offre", F.md5("texte_analyse_offre").alias("empreinte"),
            F.length("texte_analyse_offre").alias("longueur")),
    f"select id_offre, md5(t) as empreinte, length(t) as longueur from ({sql.ENRICHED})",
)
_step("enrich_dates", enrichment.with_dates, AGES,
      f"{sql.day('jour')} as date_reference_analyse, anciennete_offre_jours, delai_actualisation_jours, "
      "est_offre_recente_30j")
_step("enrich_area_code", enrichment.with_area, ("code_departement",), "code_departement")
_status = tuple(v[0] for v in sql.rules.STATUSES.values())
_step("enrich_status_labels", enrichment.with_statuses, _status, ", ".join(_status))
_step("enrich_contract_category", enrichment.with_contract, ("categorie_contrat",), "categorie_contrat")
_step("enrich_experience_category", enrichment.with_experience, ("categorie_experience",),
      "categorie_experience")
_step("enrich_job_family", enrichment.with_family, ("famille_metier_data",), "famille_metier_data", _text)
_step("enrich_technologies", enrichment.with_technologies,
      ("mention_cloud_devops", "technologies_cloud_devops_detectees"),
      "mention_cloud_devops, technologies_cloud_devops_detectees", _text)
_step("enrich_salary_period", enrichment.with_salary_period, ("periode_salaire_normalisee",),
      "periode_salaire_normalisee")
_step("enrich_working_time", enrichment.with_working_time, ("categorie_temps_travail",),
      "categorie_temps_travail")
_step("enrich_sector", enrichment.with_sector, ("secteur_activite_renseigne",), "secteur_activite_renseigne")
_step("enrich_completeness", enrichment.with_completeness,
      ("score_qualite_offre", "categorie_qualite_offre"), "score_qualite_offre, categorie_qualite_offre")

_ALL = ("id_offre", "anciennete_offre_jours", "delai_actualisation_jours", "est_offre_recente_30j",
        "code_departement", *_status, "categorie_contrat", "categorie_experience", "famille_metier_data",
        "mention_cloud_devops", "technologies_cloud_devops_detectees", "periode_salaire_normalisee",
        "categorie_temps_travail", "secteur_activite_renseigne", "score_qualite_offre",
        "categorie_qualite_offre")
register(
    "enrich_all",
    lambda spark, d: enrichment.enrich(tables.offers(spark, d)).select(*_ALL),
    f"select {', '.join(_ALL)} from ({sql.ENRICHED})",
)

# Rule lists are parameters: the same classifier on the raw documents with other families.
_FAMILIES = (
    ("french", ("elle ", "eaux"), ("le", "une")),
    ("english", ("the ", "tion"), ("and",)),
    ("digits", ("1", "2", "3"), ()),
)


def _document_families(spark, sf_dir):
    docs = tables.spread(tables.table(spark, sf_dir, "documents")).withColumn("corps", F.lower("text"))
    found = enrichment.with_family(docs, _FAMILIES, "other", "corps")
    return found.groupBy("lang", "famille_metier_data").agg(F.count(F.lit(1)).alias("documents"))


def _document_family_sql() -> str:
    branches = []
    for label, needles, words in _FAMILIES:
        branches.append((" or ".join([sql.has_any("c", needles)] + [sql.word("c", w) for w in words]),
                         sql.quoted(label)))
    return f"""select lang, {sql.cases(branches, "'other'")} as famille_metier_data, count(*) as documents
        from (select lang, lower(text) as c from documents) group by all"""


register("classify_documents", _document_families, _document_family_sql())

# Salaries
_PARSE = ("salaire_parse_ok", "periode_extraite", "salaire_min_brut", "duree_mois_brute")


def _salary_step(name: str, steps, columns: tuple[str, ...]) -> None:
    def query(spark, sf_dir):
        df = tables.offers(spark, sf_dir).transform(enrichment.with_salary_period)
        df = df.filter("salaire_renseigne")
        for step in steps:
            df = df.transform(step)
        return df.select("id_offre", *columns)

    register(name, query, f"select id_offre, {', '.join(columns)} from ({sql.salaries_sql()})")


_salary_step("salary_parse", (salaries.parse_label,), _PARSE)
_salary_step("salary_bounds", (salaries.parse_label, salaries.complete_bounds),
             ("salaire_max_brut", "format_salaire", "periode_salaire_coherente"))
_salary_step("salary_annual", (salaries.parse_label, salaries.complete_bounds, salaries.annualise),
             ("salaire_annuel_min", "salaire_annuel_max", "salaire_central_brut", "salaire_annuel_central"))
_salary_step(
    "salary_quality",
    (salaries.parse_label, salaries.complete_bounds, salaries.annualise, salaries.qualify),
    ("salaire_suspect", "salaire_exploitable", "motif_non_exploitation", "methode_normalisation_salaire"),
)
_SALARY = tuple(c for c in salaries.OUTPUT if c not in (
    "intitule_offre", "categorie_temps_travail", "periode_salaire", "processing_run_id",
    "silver_schema_version", "date_chargement"))
register(
    "salary_normalise",
    lambda spark, d: tables.salary_layer(spark, d).select(*_SALARY),
    f"select {', '.join(_SALARY)} from ({sql.salaries_sql()})",
)
_FACTS = ("salaire_parse_ok", "salaire_suspect", "salaire_exploitable", "salaire_annuel_central")
_FACT_SQL = f"""with e as ({sql.ENRICHED})
    select e.id_offre, {', '.join(f"coalesce({c}, false) as {c}" for c in _FACTS[:3])}, salaire_annuel_central
    from e left join ({sql.salaries_sql("select * from e")}) s using (id_offre)"""
register(
    "salary_join",
    lambda spark, d: salaries.join_facts(tables.enriched(spark, d), tables.salary_layer(spark, d))
    .select("id_offre", *_FACTS),
    _FACT_SQL,
)
register(
    "salary_attach",
    lambda spark, d: salaries.attach_facts(tables.enriched(spark, d)).select("id_offre", *_FACTS),
    _FACT_SQL,
)

# Marts
register("area_reference", lambda spark, d: dimension.attach_area(
    tables.enriched(spark, d), dimension.preset_reference(spark)
).select("id_offre", "code_departement_mart", "nom_departement_mart", "code_region_mart", "nom_region_mart"),
    f"""select id_offre, code_departement_mart, nom_departement_mart, code_region_mart, nom_region_mart
        from ({sql.PLACED})""")
register("mart_market_kpis", lambda spark, d: marts.market_kpis(tables.combined(spark, d)), sql.KPI)
register("mart_by_family", lambda spark, d: marts.by_family(tables.combined(spark, d)), sql.BY_FAMILY)
register("mart_by_contract", lambda spark, d: marts.by_contract(tables.combined(spark, d)), sql.BY_CONTRACT)
register("mart_by_area", lambda spark, d: marts.by_area(tables.combined(spark, d)), sql.BY_AREA)
register("mart_by_region", lambda spark, d: marts.by_region(tables.combined(spark, d)), sql.BY_REGION)
register(
    "mart_salary_analysis",
    lambda spark, d: marts.salary_analysis(tables.salary_facts(spark, d), combined=tables.combined(spark, d)),
    sql.SALARY_ANALYSIS,
)
