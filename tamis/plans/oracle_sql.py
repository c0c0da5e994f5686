"""SQL for a single-node engine that checks the registered queries (DuckDB spelling)."""

from __future__ import annotations

from tamis.operators import marts
from tamis.plans import offers_sql
from tamis.presets import areas, rules

_NAMES = {n: n for n in ("orders", "customer", "documents")}

SILVER = offers_sql.for_engine(
    offers_sql.SILVER.replace("{offers}", offers_sql.OFFERS), **_NAMES
)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def has_any(text: str, needles) -> str:
    return "(" + " or ".join(f"contains({text}, {quoted(n)})" for n in needles) + ")"


def word(text: str, value: str) -> str:
    return rf"regexp_matches({text}, '(^|[^\p{{L}}\p{{N}}]){value}([^\p{{L}}\p{{N}}]|$)')"


def cases(branches, default: str) -> str:
    body = " ".join(f"when {condition} then {value}" for condition, value in branches)
    return f"case {body} else {default} end"


def share(part: str, total: str) -> str:
    """Rounded half up in integers, so no binary fraction is involved."""
    return f"(20000 * ({part}) + ({total})) // nullif(2 * ({total}), 0) / 100.0"


def mean(column: str) -> str:
    return f"cast((200 * sum({column}) + count({column})) // nullif(2 * count({column}), 0) as double) / 100.0"


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def rate(part: str, total: str) -> str:
    """Share of a profile report: binary fraction, rounded half-even on its exact value."""
    return f"cast(format('{{:.2f}}', ({part})::double / nullif({total}, 0) * 100) as double)"


def family(text: str = "t") -> str:
    branches = []
    for label, needles, words in rules.FAMILIES:
        tests = [has_any(text, needles)] + [word(text, w) for w in words]
        branches.append((" or ".join(tests), quoted(label)))
    return cases(branches, quoted(rules.OTHER_FAMILY))


def technologies(text: str = "t") -> str:
    hits = ", ".join(
        f"case when {has_any(text, needles)} then {quoted(label)} end"
        for label, needles in rules.TECHNOLOGIES
    )
    return f"nullif(concat_ws(', ', {hits}), '')"


_DIGITS = "'^(97[1-4]|976)'"
_MAINLAND = "'^(0[1-9]|[1-8][0-9]|9[0-5])[0-9]{3}$'"


def _coded(column: str) -> str:
    value = f"trim({column})"
    return (
        f"nullif(regexp_extract({value}, {_DIGITS}, 1), ''), "
        f"case when regexp_matches({value}, {_MAINLAND}) then substr({value}, 1, 2) end"
    )


AREA = rf"""coalesce(
    nullif(regexp_extract(upper(trim(code_commune)), '^(2A|2B)', 1), ''),
    {_coded('code_commune')}, {_coded('code_postal')},
    nullif(regexp_extract(upper(trim(libelle_lieu_travail)),
        '^(2A|2B|97[1-4]|976|0[1-9]|[1-8][0-9]|9[0-5])\s*-', 1), ''))"""

CONTRACT = cases(
    [("est_alternance", quoted(rules.APPRENTICESHIP))]
    + [(f"code_type_contrat in ({', '.join(map(quoted, codes))})", quoted(label))
       for label, codes in rules.CONTRACTS]
    + [("code_type_contrat is null", quoted(rules.UNKNOWN))],
    quoted(rules.OTHER),
)
EXPERIENCE = cases(
    [("libelle_experience is null", quoted(rules.UNKNOWN))]
    + [(has_any("lower(libelle_experience)", needles), quoted(label)) for label, needles in rules.EXPERIENCE],
    quoted(rules.OTHER),
)
_TIME = "lower(concat(libelle_duree_travail, ' ', libelle_duree_travail_converti))"
WORKING_TIME = cases(
    [(has_any(_TIME, needles), quoted(label)) for label, needles in rules.WORKING_TIME]
    + [("coalesce(libelle_duree_travail, libelle_duree_travail_converti) is null", quoted(rules.UNKNOWN))],
    quoted(rules.OTHER),
)
STATUSES = ", ".join(
    f"if({flag}, {quoted(yes)}, {quoted(no)}) as {name}" for flag, (name, yes, no) in rules.STATUSES.items()
)
SCORE = " + ".join(
    [f"({c} is not null)::int" for c in
     ("id_offre", "intitule_offre", "description_offre", "code_type_contrat", "code_rome")]
    + [f"coalesce({c}, false)::int" for c in
       ("localisation_renseignee", "information_entreprise_disponible", "salaire_renseigne")]
)

ENRICHED = f"""
select *,
    technologies_cloud_devops_detectees is not null as mention_cloud_devops,
    if(date_creation is null or jour is null, null, greatest(0, date_diff('day', date_creation::date, jour)))
        as anciennete_offre_jours,
    if(date_creation is null or date_actualisation is null, null,
        greatest(0, date_diff('day', date_creation::date, date_actualisation::date)))
        as delai_actualisation_jours,
    coalesce(date_creation::date >= jour - 30, false) as est_offre_recente_30j,
    {cases([(f"score_qualite_offre >= {low}", quoted(label)) for label, low in rules.COMPLETENESS],
           quoted(rules.INCOMPLETE))} as categorie_qualite_offre
from (
    select *,
        coalesce(date_ingestion, date_chargement)::date as jour,
        {AREA} as code_departement,
        {CONTRACT} as categorie_contrat,
        {EXPERIENCE} as categorie_experience,
        {WORKING_TIME} as categorie_temps_travail,
        {STATUSES},
        {family()} as famille_metier_data,
        {technologies()} as technologies_cloud_devops_detectees,
        coalesce(periode_salaire, {quoted(rules.UNKNOWN_PERIOD)}) as periode_salaire_normalisee,
        coalesce(code_secteur_activite, libelle_secteur_activite) is not null as secteur_activite_renseigne,
        {SCORE} as score_qualite_offre
    from (
        select *, lower(array_to_string([coalesce(intitule_offre, ''), coalesce(description_offre, ''),
            coalesce(libelle_rome, ''), coalesce(libelle_appellation, '')], ' ')) as t
        from ({SILVER}) s
    )
)
"""

REFERENCE = (
    "select a.code_departement, a.nom_departement, a.code_region, r.nom_region from (values "
    + ", ".join(f"({quoted(a)}, {quoted(b)}, {quoted(c)})" for a, b, c in areas.AREAS)
    + ") a(code_departement, nom_departement, code_region) left join (values "
    + ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in areas.REGIONS)
    + ") r(code_region, nom_region) using (code_region)"
)

PLACED = f"""
select e.*,
    coalesce(e.code_departement, '{rules.NO_AREA}') as code_departement_mart,
    coalesce(d.nom_departement, '{rules.UNKNOWN}') as nom_departement_mart,
    coalesce(d.code_region, '{rules.NO_REGION}') as code_region_mart,
    coalesce(d.nom_region, '{rules.UNKNOWN}') as nom_region_mart
from ({ENRICHED}) e left join ({REFERENCE}) d on d.code_departement = e.code_departement
"""

# Salary amounts as integers of a ten-thousandth, so that no step rounds in binary.
_LABEL = (
    r"'(?s)^(Annuel|Mensuel|Horaire)\s+de\s+([0-9]+\.?[0-9]*)\s+Euros"
    r"(?:\s+à\s+([0-9]+\.?[0-9]*)\s+Euros)?(?:\s+sur\s+([0-9]+\.?[0-9]*)\s+mois)?(?:\s+-\s+.*)?$'"
)


def _units(group: int) -> str:
    return (
        f"cast(try_cast(nullif(regexp_extract(trim(salaire_libelle), {_LABEL}, {group}), '') "
        f"as decimal(18, 4)) * 10000 as bigint)"
    )


def _reasons() -> str:
    r = rules.REASONS
    return cases(
        [
            ("p is null", quoted(r["unparsed"])),
            ("not periode_salaire_coherente", quoted(r["incoherent"])),
            ("p = 'Horaire'", quoted(r["hourly"])),
            ("salaire_suspect", quoted(r["suspect"])),
            ("ylo is null or yhi is null", quoted(r["not_annual"])),
            ("ylo <= 0", quoted(r["not_positive"])),
            ("yhi < ylo", quoted(r["reversed"])),
        ],
        "null",
    )


SALARIES = f"""
select id_offre, famille_metier_data, categorie_contrat, code_departement, salaire_libelle,
    batch_id, fichier_source_silver, date_chargement,
    periode_salaire_normalisee, p is not null as salaire_parse_ok, p as periode_extraite,
    periode_salaire_coherente,
    lo / 10000.0 as salaire_min_brut, hi / 10000.0 as salaire_max_brut,
    (lo + hi + 100) // 200 / 100.0 as salaire_central_brut,
    if(p is null, null, if(hi0 is null, '{rules.SINGLE_AMOUNT}', '{rules.AMOUNT_RANGE}')) as format_salaire,
    months / 10000.0 as duree_mois_brute,
    ylo / 10000.0 as salaire_annuel_min, yhi / 10000.0 as salaire_annuel_max,
    (ylo + yhi + 100) // 200 as cents,
    (ylo + yhi + 100) // 200 / 100.0 as salaire_annuel_central,
    {cases([("p is null", quoted(rules.METHODS["unparsed"])), ("p = 'Horaire'", quoted(rules.METHODS["hourly"])),
            ("p = 'Annuel'", quoted(rules.METHODS["yearly"])), ("p = 'Mensuel'", quoted(rules.METHODS["monthly"]))],
           "null")} as methode_normalisation_salaire,
    200000.0 as seuil_salaire_annuel_suspect, salaire_suspect,
    {_reasons()} as motif_non_exploitation,
    ({_reasons()}) is null as salaire_exploitable
from (
    select *, coalesce(yhi > 2000000000, false) as salaire_suspect,
        coalesce(p = periode_salaire_normalisee, false) as periode_salaire_coherente
    from (
        select *, lo * (case p when 'Annuel' then 1 when 'Mensuel' then 12 end) as ylo,
            hi * (case p when 'Annuel' then 1 when 'Mensuel' then 12 end) as yhi
        from (
            select *, if(lo is null, null, coalesce(hi0, lo)) as hi
            from (
                select *, nullif(regexp_extract(trim(salaire_libelle), {_LABEL}, 1), '') as p,
                    {_units(2)} as lo, {_units(3)} as hi0, {_units(4)} as months
                from ({{enriched}}) e where salaire_renseigne
            )
        )
    )
)
"""


def salaries_sql(source: str = ENRICHED) -> str:
    return SALARIES.replace("{enriched}", source)


def _condition_sql() -> dict[str, str]:
    """Measure -> predicate. Written apart from the Spark measures on purpose."""
    out = {}
    for part, value in marts.FAMILY_MEASURES.items():
        out[f"nombre_offres_{part}"] = f"famille_metier_data = {quoted(value)}"
    for part, value in marts.CONTRACT_MEASURES.items():
        out[f"nombre_offres_{part}"] = f"categorie_contrat = {quoted(value)}"
    for part, value in marts.CLASS_MEASURES.items():
        out[f"nombre_offres_{part}"] = f"categorie_qualite_offre = {quoted(value)}"
    out |= {
        "nombre_offres_autres_contrats": f"categorie_contrat in ('{rules.OTHER}', '{rules.UNKNOWN}')",
        "nombre_offres_salaire_renseigne": "salaire_renseigne",
        "nombre_offres_salaire_non_renseigne": "salaire_renseigne is not true",
        "nombre_offres_mention_cloud_devops": "mention_cloud_devops",
        "nombre_offres_difficiles_a_pourvoir": "offre_difficile_a_pourvoir",
        "nombre_offres_information_entreprise_disponible": "information_entreprise_disponible",
        "nombre_offres_geolocalisees": "coordonnees_renseignees",
        "nombre_offres_recentes_30j": "est_offre_recente_30j",
        "nombre_offres_non_signalees_difficiles": "offre_difficile_a_pourvoir is not true",
        "nombre_offres_information_entreprise_absente": "information_entreprise_disponible is not true",
        "nombre_offres_non_geolocalisees": "coordonnees_renseignees is not true",
    }
    return out


CONDITIONS = _condition_sql()


def _lineage() -> str:
    return (
        "max(batch_id) as batch_id, max(fichier_source_silver) as fichier_source_silver, "
        f"{stamp('max(date_chargement)')} as date_chargement_batch"
    )


def _means() -> str:
    return ", ".join(f"{mean(c)} as {n}" for n, c in marts.MEANS.items())


def mart_sql(source: str, keys: dict[str, str], shares: dict[str, str | None], rank: str | None,
             covers: bool, total: str = "nombre_offres", unknown: str = "0") -> str:
    """Group, count distinct ids per condition, then divide. ``shares``: count -> share or None."""
    group = ", ".join(f"{expr} as {name}" for name, expr in keys.items())
    counts = ", ".join(
        f"count(distinct id_offre) filter (where {CONDITIONS[name]}) as {name}" for name in shares
    )
    covered = f"count(distinct code_departement) as {marts.COVERED}," if covers else ""
    pcts = "".join(f", {share(name, total)} as {pct}" for name, pct in shares.items() if pct)
    ranked = (
        f", row_number() over (order by {unknown}, {total} desc, {next(iter(keys))}) as {rank}, "
        f"{share(total, '(select count(distinct id_offre) from offres)')} as part_offres_pct"
        if rank else ""
    )
    return f"""
with offres as ({source}), comptes as (
    select {group + ',' if group else ''} {_lineage()}, count(distinct id_offre) as {total},
        {covered} {counts}, {_means()}
    from offres {'group by ' + ', '.join(keys.values()) if keys else ''}
)
select * {pcts} {ranked} from comptes
"""


_SIGNALS = {
    "nombre_offres_mention_cloud_devops": "taux_mention_cloud_devops_pct",
    "nombre_offres_difficiles_a_pourvoir": "taux_offres_difficiles_a_pourvoir_pct",
    "nombre_offres_information_entreprise_disponible": "taux_information_entreprise_disponible_pct",
    "nombre_offres_geolocalisees": "taux_offres_geolocalisees_pct",
    "nombre_offres_recentes_30j": "taux_offres_recentes_30j_pct",
}
_CLASSES = {f"nombre_offres_{p}": f"part_offres_{p}_pct" for p in marts.CLASS_MEASURES}
_STATED = {"nombre_offres_salaire_renseigne": "taux_transparence_salariale_pct"}
_MISSING = {"nombre_offres_salaire_non_renseigne": None}


def _parts(values, suffix: str = "") -> dict[str, str | None]:
    return {f"nombre_offres_{p}": f"part_{p}{suffix}_pct" for p in values}


_F, _C = marts.FAMILY_MEASURES, marts.CONTRACT_MEASURES

KPI = mart_sql(
    ENRICHED, {},
    _parts(_F) | _parts(_C) | {"nombre_offres_autres_contrats": "part_autres_contrats_pct"} | _STATED
    | {"nombre_offres_salaire_non_renseigne": "taux_salaire_non_renseigne_pct"}
    | _SIGNALS
    | {"nombre_offres_mention_cloud_devops": "taux_offres_mention_cloud_devops_pct",
       "nombre_offres_recentes_30j": "part_offres_recentes_30j_pct",
       "nombre_offres_non_signalees_difficiles": None,
       "nombre_offres_information_entreprise_absente": "taux_information_entreprise_absente_pct",
       "nombre_offres_non_geolocalisees": "taux_offres_non_geolocalisees_pct"}
    | _CLASSES,
    None, True, "nombre_total_offres",
)
BY_FAMILY = mart_sql(
    ENRICHED, {"famille_metier_data": "famille_metier_data"},
    _parts(_C, "_dans_famille") | _STATED | _MISSING | _SIGNALS | _CLASSES,
    "rang_famille_metier", True,
)
BY_CONTRACT = mart_sql(
    ENRICHED, {"categorie_contrat": "categorie_contrat"},
    _parts(_F, "_dans_contrat") | _STATED | _MISSING | _SIGNALS | _CLASSES,
    "rang_type_contrat", True,
)
BY_AREA = mart_sql(
    f"select * exclude (code_departement), code_departement_mart as code_departement from ({PLACED})",
    {"code_departement": "code_departement", "nom_departement": "nom_departement_mart",
     "code_region": "code_region_mart", "nom_region": "nom_region_mart"},
    _parts(_F) | {"nombre_offres_autre_data_numerique": None} | _parts(_C) | _STATED | _SIGNALS | _CLASSES,
    "rang_departement", False, unknown=f"(code_departement = '{rules.NO_AREA}')::int",
)
BY_REGION = mart_sql(
    PLACED, {"code_region": "code_region_mart", "nom_region": "nom_region_mart"},
    _parts(_F) | _parts(_C) | _STATED | _MISSING | _SIGNALS | _CLASSES,
    "rang_region", True, unknown=f"(code_region = '{rules.NO_REGION}')::int",
)


def _quantile(q: float) -> str:
    return f"floor(quantile_cont(cents::double, {q}) filter (where bon) + 0.5)"


SALARY_ANALYSIS = f"""
with offres as ({PLACED}), salaires as ({salaries_sql("select * from offres")}),
base as (
    select o.id_offre, o.famille_metier_data, o.categorie_contrat, o.code_region_mart, o.nom_region_mart,
        o.salaire_renseigne, o.batch_id, o.fichier_source_silver, o.date_chargement,
        coalesce(s.salaire_suspect, false) as suspect, coalesce(s.salaire_exploitable, false) as bon, s.cents
    from offres o left join salaires s using (id_offre)
),
axes as (
    select *, unnest([
        {{'o': 1, 'a': 'Global', 'c': 'GLOBAL', 'm': 'Ensemble'}},
        {{'o': 2, 'a': 'Famille métier', 'c': famille_metier_data, 'm': famille_metier_data}},
        {{'o': 3, 'a': 'Type de contrat', 'c': categorie_contrat, 'm': categorie_contrat}},
        {{'o': 4, 'a': 'Région', 'c': code_region_mart, 'm': nom_region_mart}}]) as x
    from base
),
comptes as (
    select x.o as ordre_axe, x.a as axe_analyse, x.c as code_modalite, x.m as modalite, {_lineage()},
        count(distinct id_offre) as nombre_offres,
        count(distinct id_offre) filter (where salaire_renseigne) as nombre_salaires_renseignes,
        count(distinct id_offre) filter (where suspect) as nombre_salaires_suspects,
        count(distinct id_offre) filter (where bon) as nombre_salaires_exploitables,
        count(distinct id_offre) filter (where salaire_renseigne and not bon) as nombre_salaires_non_exploitables,
        cast((2 * sum(cents) filter (where bon) + count(*) filter (where bon))
            // nullif(2 * count(*) filter (where bon), 0) as double) / 100.0 as salaire_annuel_moyen,
        {_quantile(0.25)} as c1, {_quantile(0.5)} as c2, {_quantile(0.75)} as c3,
        min(cents) filter (where bon) / 100.0 as salaire_annuel_min_observe,
        max(cents) filter (where bon) / 100.0 as salaire_annuel_max_observe
    from axes group by all
)
select * exclude (c1, c2, c3), c1 / 100 as premier_quartile, c2 / 100 as salaire_annuel_median,
    c3 / 100 as troisieme_quartile, (c3 - c1) / 100 as ecart_interquartile,
    row_number() over (partition by axe_analyse order by nombre_offres desc, modalite) as rang_modalite,
    {share("nombre_offres", "(select count(distinct id_offre) from offres)")} as part_offres_pct,
    {share("nombre_salaires_renseignes", "nombre_offres")} as taux_transparence_salariale_pct,
    {share("nombre_salaires_exploitables", "nombre_offres")} as taux_salaires_exploitables_sur_total_pct,
    {share("nombre_salaires_exploitables", "nombre_salaires_renseignes")}
        as taux_exploitabilite_salaires_renseignes_pct
from comptes
"""
