"""Acquisition, bronze and silver queries over records derived from the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import dates, flags
from tamis.operators import bronze, checks, cleaning, enrichment, gates, identity, merge
from tamis.plans import records_sql, tables
from tamis.plans.oracle_sql import quoted, stamp
from tamis.plans.registry import register
from tamis.presets import acquisition

QUERIES = records_sql.QUERIES


def events_sql(text_: str) -> str:
    return text_.replace("{events}", "events")


HITS, RECORDS, CLEAN = (events_sql(s) for s in (records_sql.HITS, records_sql.RECORDS, records_sql.CLEAN_RECORDS))


def _derived(text_: str):
    # ``spark.sql`` formats its text, so the braces of JSON literals are doubled.
    escaped = text_.replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")

    def build(spark, sf_dir):
        tables.prepare(spark)
        return spark.sql(escaped, events=tables.spread(tables.table(spark, sf_dir, "events")))

    return build


hits, records, clean_records = (
    _derived(t) for t in (records_sql.HITS, records_sql.RECORDS, records_sql.CLEAN_RECORDS)
)


def values(rows) -> str:
    return "(values " + ", ".join("(" + ", ".join(r) + ")" for r in rows) + ")"


def check_rows(pairs: dict[str, str], source: str, more: str = "") -> str:
    """Long-form checks from one aggregate."""
    wide = ", ".join(f"cast({expression} as bigint) as {name}" for name, expression in pairs.items())
    return f"unpivot (select {wide} from ({source}) src {more}) on columns(*) into name controle value violations"


_ORDERED = f"{values([(quoted(q), str(i)) for i, q in enumerate(QUERIES, 1)])} q(requete, ordre)"

# Acquisition merge


def _merged(spark, sf_dir):
    return merge.merge_hits(hits(spark, sf_dir), QUERIES, "id", "requete", ["ts", "event_id"])


register(
    "merge_acquisitions",
    lambda spark, d: _merged(spark, d).withColumn(
        "search_keywords", F.array_join("search_keywords", ",")
    ),
    f"""
    with h as (select h.*, q.ordre from ({HITS}) h join {_ORDERED} using (requete) where id <> ''),
    premiers as (select *, row_number() over (partition by id order by ordre, ts, event_id) as n from h),
    mots as (select id, string_agg(requete, ',' order by ordre) as search_keywords
        from (select distinct id, requete, ordre from h) group by id)
    select id, requete as search_keyword, props, value, search_keywords from premiers join mots using (id)
    where n = 1
    """,
)
register(
    "merge_funnel",
    lambda spark, d: merge.funnel(hits(spark, d), QUERIES, "id", "requete"),
    f"""
    with h as (select h.*, ordre, nullif(id, '') as cle from ({HITS}) h join {_ORDERED} using (requete)),
    paires as (select cle, ordre, count(*) as n, min(ordre) over (partition by cle) as premier,
        count(*) over (partition by cle) as trouve_par from h where cle is not null group by cle, ordre),
    bruts as (select ordre, count(*) as resultats_api, count(*) filter (where cle is null) as sans_id
        from h group by ordre),
    ids as (select ordre, count(*) filter (where premier = ordre) as nouvelles,
        count(*) filter (where premier <> ordre) as deja_couvertes,
        cast(sum(n - 1) as bigint) as doublons_dans_requete, count(*) as nombre_couvertes,
        count(*) filter (where trouve_par = 1) as nombre_exclusives from paires group by ordre)
    select q.ordre, q.requete, {', '.join(f'coalesce({c}, 0) as {c}' for c in (
        'resultats_api', 'nouvelles', 'deja_couvertes', 'doublons_dans_requete', 'sans_id',
        'nombre_couvertes', 'nombre_exclusives'))}
    from {_ORDERED} left join bruts using (ordre) left join ids using (ordre)
    """,
)
register(
    "merge_coverage",
    lambda spark, d: merge.coverage(_merged(spark, d), QUERIES),
    f"""
    with h as (select distinct id, requete from ({HITS}) where id <> ''),
    n as (select *, count(*) over (partition by id) as k from h)
    select q.requete, count(n.id) as nombre_couvertes, count(n.id) filter (where k = 1) as nombre_exclusives
    from {_ORDERED} left join n using (requete) group by q.requete
    """,
)

# Raw to bronze

_FLAT = {
    "lieuTravail_libelle": "lieuTravail.libelle", "lieuTravail_codePostal": "lieuTravail.codePostal",
    "lieuTravail_commune": "lieuTravail.commune", "entreprise_nom": "entreprise.nom",
    "entreprise_description": "entreprise.description", "salaire_libelle": "salaire.libelle",
    "contexteTravail_horaires": "contexteTravail.horaires", "id": "id", "intitule": "intitule",
    "search_keyword": "search_keyword", "search_keywords": "search_keywords",
    "competences": "competences", "props": "props",
}


def _bronze(spark, sf_dir, source=records):
    flat = bronze.flatten(bronze.parse(source(spark, sf_dir)), extra=("props",))
    return bronze.with_lineage(flat, "batch_1", "run_1", "batch.json", "raw/batch.json")


register(
    "bronze_flatten",
    lambda spark, d: _bronze(spark, d).select(
        "event_id", *_FLAT, "lieuTravail_latitude", "nombrePostes", "alternance"),
    f"""select event_id, {', '.join(f"record ->> '$.{path}' as {name}" for name, path in _FLAT.items())},
        cast(record ->> '$.lieuTravail.latitude' as double) as "lieuTravail_latitude",
        cast(record ->> '$.nombrePostes' as bigint) as "nombrePostes",
        cast(record ->> '$.alternance' as boolean) as alternance
        from ({RECORDS})""",
)
register(
    "bronze_json_text",
    lambda spark, d: tables.table(spark, d, "events")
    .select("event_id", F.from_json("props", "struct<k:bigint,absent:string>").alias("s"))
    .select("event_id", bronze.json_text(F.col("s")).alias("json"),
            bronze.json_text(F.array("s.k", F.col("event_id"))).alias("liste")),
    """select event_id, '{"k":' || (props ->> '$.k') || ',"absent":null}' as json,
        '[' || (props ->> '$.k') || ',' || event_id || ']' as liste from events""",
)
register(
    "bronze_verbatim_record",
    lambda spark, d: _bronze(spark, d).select("event_id", "raw_record"),
    f"select event_id, record as raw_record from ({RECORDS})",
)
register(
    "bronze_lineage",
    lambda spark, d: _bronze(spark, d).groupBy(
        "batch_id", "processing_run_id", "bronze_schema_version", "raw_source_file", "raw_source_object_key"
    ).agg(F.count(F.lit(1)).alias("lignes")),
    """select 'batch_1' as batch_id, 'run_1' as processing_run_id, '2.0.0' as bronze_schema_version,
        'batch.json' as raw_source_file, 'raw/batch.json' as raw_source_object_key, count(*) as lignes
        from events""",
)


def _drift_sql() -> str:
    parts = []
    for name, expected in acquisition.NESTED_FIELDS.items():
        known = ", ".join(map(quoted, expected))
        value = f"json_extract(record, '$.{name}')"
        parts.append(f"""
        select '{name}' as champ, k as cle, false as bloquant from (
            select unnest(json_keys({value})) as k from ({RECORDS}) where json_type({value}) = 'OBJECT')
        where k not in ({known})
        union all select '{name}', null, true from ({RECORDS})
        where coalesce(json_type({value}), 'NULL') not in ('OBJECT', 'NULL')""")
    return f"select *, count(*) as enregistrements from ({' union all '.join(parts)}) group by all"


register("bronze_schema_drift", lambda spark, d: bronze.schema_drift(bronze.parse(records(spark, d))), _drift_sql())
register(
    "bronze_top_level_keys",
    lambda spark, d: bronze.top_level_keys(bronze.parse(records(spark, d))),
    f"""select cle, count(*) as enregistrements from (select unnest(json_keys(record)) as cle from ({RECORDS}))
        group by cle""",
)


def _raw_rules(known: bool) -> str:
    view = f"""select nullif(record ->> '$.id', '') as id, nullif(record ->> '$.search_keyword', '') as mot,
        json_type(json_extract(record, '$.search_keywords')) as t,
        json_extract_string(record, '$.search_keywords[*]') as mots,
        nullif(record ->> '$.ingestion_timestamp', '') as instant from ({RECORDS})"""
    full = "t = 'ARRAY' and len(mots) > 0"
    listed = ", ".join(map(quoted, QUERIES))
    rules = {
        "lot_vide": "(count(*) = 0)::int",
        "entrees_non_objet": "0",
        "sans_id": "count(*) filter (where id is null)",
        "ids_dupliques": "count(id) - count(distinct id)",
        "sans_mot_cle": "count(*) filter (where mot is null)",
        "sans_liste_mots_cles": "count(*) filter (where t is null)",
        "mots_cles_non_liste": "count(*) filter (where t <> 'ARRAY')",
        "mots_cles_vides": "count(*) filter (where t = 'ARRAY' and len(mots) = 0)",
        "mot_cle_hors_liste": f"count(*) filter (where {full} and mot is not null and not list_contains(mots, mot))",
        "sans_instant": f"count(*) filter (where {full} and instant is null)",
        "instants_multiples": "(count(distinct instant) <> 1)::int",
    }
    if known:
        rules["mots_cles_inconnus"] = (
            f"count(*) filter (where {full} and len(list_filter(mots, lambda m: m not in ({listed}))) > 0)"
        )
    return check_rows(rules, view)


register("raw_preconditions", lambda spark, d: bronze.record_checks(bronze.parse(records(spark, d))),
         _raw_rules(False))
register("raw_gate", lambda spark, d: bronze.record_checks(bronze.parse(records(spark, d)), QUERIES),
         _raw_rules(True))


def _orders_and_lines(spark, sf_dir):
    orders = tables.table(spark, sf_dir, "orders"), "o_orderkey"
    lines = tables.table(spark, sf_dir, "lineitem"), "l_orderkey"
    return orders, lines


register(
    "non_loss_check",
    lambda spark, d: identity.non_loss(*_orders_and_lines(spark, d)),
    check_rows(
        {
            "ecart_lignes": "abs((select count(*) from orders) - (select count(*) from lineitem))",
            "ids_nuls": "0",
            "ids_dupliques": "(select count(*) - count(distinct l_orderkey) from lineitem)",
            "ids_absents": "(select count(*) from orders where o_orderkey not in (select l_orderkey from lineitem))",
            "ids_inattendus":
                "(select count(distinct l_orderkey) from lineitem where l_orderkey not in "
                "(select o_orderkey from orders))",
        },
        "select 1",
    ),
)

# Bronze to silver


def _silver(spark, sf_dir, source=clean_records):
    return cleaning.to_silver(
        _bronze(spark, sf_dir, source), "run_2", "bronze/part.parquet", F.lit("2024-02-01 11:00:00").cast("timestamp")
    )


_NAMES = {"c_custkey": "id_client", "c_name": "nom_client", "c_mktsegment": "segment"}
register(
    "clean_rename",
    lambda spark, d: cleaning.rename(tables.table(spark, d, "customer"), _NAMES, ("c_acctbal", "inconnue")),
    "select c_custkey as id_client, c_name as nom_client, c_nationkey, c_mktsegment as segment from customer",
)


def _required(spark, sf_dir):
    df = tables.table(spark, sf_dir, "customer")
    missing = checks.required_columns(df, ("c_custkey", "c_name", "c_phone", "c_address"))
    return df.agg(F.lit(", ".join(missing)).alias("colonnes_manquantes"), F.count(F.lit(1)).alias("lignes"))


register("required_columns", _required,
         "select 'c_address, c_phone' as colonnes_manquantes, count(*) as lignes from customer")

_PAD = r"""select doc_id, chr(9) || ' ' || text || chr(160) || chr(10) as texte,
    case when doc_id % 3 = 0 then '  ' || chr(13) else lang end as langue,
    upper(source) as mot from {documents}"""


def _padded(spark, sf_dir):
    return spark.sql(_PAD.replace("chr(160)", r"' '"),
                     documents=tables.spread(tables.table(spark, sf_dir, "documents")))


register(
    "clean_text",
    lambda spark, d: cleaning.clean_text(_padded(spark, d)).select(
        "doc_id", F.md5("texte").alias("empreinte"), F.length("texte").alias("longueur"), "langue", "mot"),
    rf"""select doc_id, md5(t) as empreinte, length(t) as longueur, nullif(trim(langue, chr(13) || ' '), '') as langue,
        mot
        from (select *, regexp_replace(texte, '^[\s\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+|[\s\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+$', '', 'g') as t
            from ({_PAD.replace("{documents}", "documents")}))""",
)
register(
    "clean_keyword",
    lambda spark, d: cleaning.lower_keyword(_padded(spark, d), "mot").groupBy("mot")
    .agg(F.count(F.lit(1)).alias("nombre")),
    "select lower(source) as mot, count(*) as nombre from documents group by 1",
)

_DATES = r"""select event_id,
    case event_id % 5 when 0 then 'hier' when 1 then null when 2 then ''
        else cast(cast(ts as date) as string) || 'T10:05:00Z' end as iso,
    case event_id % 4 when 0 then 'x' when 1 then cast(cast(ts as date) as string) || '_23-59-01'
        when 2 then cast(cast(ts as date) as string) else null end as estampille
    from {events}"""
register(
    "clean_dates",
    lambda spark, d: cleaning.parse_dates(
        spark.sql(_DATES, events=tables.table(spark, d, "events")), ("iso",), ("estampille",)),
    f"""select event_id, {stamp("try_strptime(iso, '%Y-%m-%dT%H:%M:%SZ')")} as iso,
        {stamp("try_strptime(estampille, '%Y-%m-%d_%H-%M-%S')")} as estampille
        from ({events_sql(_DATES)})""",
)


def _date_pairs(spark, sf_dir):
    lines = tables.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("maj"))
    orders = tables.table(spark, sf_dir, "orders")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")


register(
    "date_coherence",
    lambda spark, d: _date_pairs(spark, d).select(
        "o_orderkey", cleaning.date_coherence("o_orderdate", "maj").alias("coherente"),
        dates.days_between(F.col("o_orderdate"), F.col("maj")).alias("delai_jours")),
    """select o_orderkey, maj >= o_orderdate as coherente,
        case when maj is not null then greatest(0, date_diff('day', o_orderdate::date, maj::date)) end as delai_jours
        from orders left join (select l_orderkey, min(l_shipdate) as maj from lineitem group by 1) l
        on l_orderkey = o_orderkey""",
)

_PEOPLE = r"""select c_custkey,
    case when c_custkey % 4 <> 0 then c_name end as nom,
    case when c_custkey % 3 = 0 then c_mktsegment end as description,
    case when c_custkey % 5 = 0 then 1.5 end as lat, case when c_custkey % 10 = 0 then 2.5 end as lon,
    case when c_custkey % 7 = 0 then 'L' end as lieu, case when c_custkey % 11 = 0 then 'C' end as commune,
    case c_custkey % 6 when 0 then ' annuel de 1' when 1 then 'MENSUEL' when 2 then 'Horaire de 9'
        when 3 then 'De Annuel' when 4 then 'x' end as salaire
    from {customer}"""


def _people(spark, sf_dir):
    return spark.sql(_PEOPLE, customer=tables.table(spark, sf_dir, "customer"))


_PEOPLE_SQL = _PEOPLE.replace("{customer}", "customer")
register(
    "company_flags",
    lambda spark, d: _people(spark, d).select(
        "c_custkey", *[c.alias(n) for n, c in cleaning.company_flags("nom", "description").items()]),
    f"""select c_custkey, nom is not null as entreprise_renseignee,
        description is not null as description_entreprise_renseignee,
        coalesce(nom, description) is not null as information_entreprise_disponible from ({_PEOPLE_SQL})""",
)
register(
    "salary_flags",
    lambda spark, d: _people(spark, d).select(
        "c_custkey", *[c.alias(n) for n, c in cleaning.salary_flags("salaire").items()]),
    f"""select c_custkey, salaire is not null as salaire_renseigne,
        case lower(regexp_extract(salaire, '(?i)^\\s*(annuel|mensuel|horaire)', 1))
            when 'annuel' then 'Annuel' when 'mensuel' then 'Mensuel' when 'horaire' then 'Horaire' end
            as periode_salaire from ({_PEOPLE_SQL})""".replace("\\\\s", "\\s"),
)
register(
    "location_flags",
    lambda spark, d: _people(spark, d).select(
        "c_custkey",
        *[c.alias(n) for n, c in cleaning.location_flags("lat", "lon", ("lieu", "commune")).items()]),
    f"""select c_custkey, lat + lon is not null as coordonnees_renseignees,
        (lat + lon is not null or lieu is not null or commune is not null) as localisation_renseignee
        from ({_PEOPLE_SQL})""",
)

_WORDS = r"""select l_orderkey, l_linenumber, case (l_orderkey + l_linenumber) % 9
    when 0 then 'true' when 1 then ' OUI ' when 2 then '1' when 3 then 'Yes' when 4 then 'FALSE'
    when 5 then 'non' when 6 then '0' when 7 then 'no' end as mot, l_returnflag from {lineitem}"""
register(
    "boolean_words",
    lambda spark, d: spark.sql(_WORDS, lineitem=tables.table(spark, d, "lineitem"))
    .groupBy("mot").agg(F.min(flags.to_boolean(F.col("mot"))).alias("valeur"), F.count(F.lit(1)).alias("nombre")),
    f"""select mot, min(case when trim(lower(mot)) in ('true', '1', 'yes', 'oui') then true
        when trim(lower(mot)) in ('false', '0', 'no', 'non') then false end) as valeur, count(*) as nombre
        from ({_WORDS.replace("{lineitem}", "lineitem")}) group by mot""",
)
register(
    "boolean_rejects",
    lambda spark, d: tables.table(spark, d, "lineitem").agg(
        F.count_if(flags.is_bad_boolean(F.col("l_returnflag"))).alias("rejets"), F.count(F.lit(1)).alias("lignes")),
    "select count(*) as rejets, count(*) as lignes from lineitem",
)


def _typed(spark, sf_dir):
    df = spark.sql(
        "select event_id as cle, cast(value as string) as v, props, "
        "case when event_id % 3 = 0 then 'oui' when event_id % 3 = 1 then 'non' end as ok, "
        "get_json_object(props, '$.k') as k from {events}", events=tables.table(spark, sf_dir, "events"))
    return cleaning.final_types(df, ("ok",), ("k",), ("v",), "cle").drop("props")


register(
    "final_types", _typed,
    """select cast(event_id as varchar) as cle, cast(value as double) as v, case event_id % 3 when 0 then true
        when 1 then false end as ok, cast(props ->> '$.k' as bigint) as k from events""",
)
register(
    "key_validity",
    lambda spark, d: cleaning.key_checks(hits(spark, d), "id"),
    check_rows(
        {"cles_manquantes": "count(*) filter (where id is null or trim(id) = '')",
         "cles_dupliquees": "count(id) - count(distinct id)"}, HITS),
)
register(
    "single_valued_columns",
    lambda spark, d: checks.long_form(
        _bronze(spark, d),
        {"batch_id": checks.not_single("batch_id", "batch_1"), "autre_batch": checks.not_single("batch_id", "x"),
         "search_keyword": checks.not_single("search_keyword"),
         "bronze_schema_version": checks.not_single("bronze_schema_version", "2.0.0")}),
    check_rows({"batch_id": "0", "autre_batch": "1",
                "search_keyword": "(count(distinct m) <> 1 or count(m) <> count(*))::int",
                "bronze_schema_version": "0"},
               f"select record ->> '$.search_keyword' as m from ({RECORDS})"),
)

_SILVER = ("id_offre", "intitule_offre", "date_creation", "date_actualisation", "date_ingestion",
           "date_actualisation_coherente", "entreprise_renseignee", "description_entreprise_renseignee",
           "information_entreprise_disponible", "salaire_renseigne", "periode_salaire",
           "coordonnees_renseignees", "localisation_renseignee", "nombre_postes", "est_alternance",
           "mot_cle_recherche", "silver_schema_version")


def _silver_sql() -> str:
    def get(path: str) -> str:
        return f"nullif(trim(record ->> '$.{path}'), '')"

    return f"""
    select id_offre, intitule_offre, cree as date_creation, maj as date_actualisation,
        '2024-02-01 10:00:00' as date_ingestion, maj >= cree as date_actualisation_coherente,
        nom is not null as entreprise_renseignee, description is not null as description_entreprise_renseignee,
        coalesce(nom, description) is not null as information_entreprise_disponible,
        salaire is not null as salaire_renseigne,
        case when lower(salaire) like 'annuel%' then 'Annuel' when lower(salaire) like 'mensuel%' then 'Mensuel' end
            as periode_salaire,
        lat is not null as coordonnees_renseignees, (lat is not null or lieu is not null) as localisation_renseignee,
        nombre_postes, est_alternance, mot_cle_recherche, '2.0.0' as silver_schema_version
    from (
        select {get('id')} as id_offre, {get('intitule')} as intitule_offre, {get('entreprise.nom')} as nom,
            {get('entreprise.description')} as description, {get('salaire.libelle')} as salaire,
            {get('lieuTravail.latitude')} as lat, {get('lieuTravail.libelle')} as lieu,
            {stamp("try_strptime(record ->> '$.dateCreation', '%Y-%m-%dT%H:%M:%SZ')")} as cree,
            {stamp("try_strptime(record ->> '$.dateActualisation', '%Y-%m-%dT%H:%M:%SZ')")} as maj,
            cast(record ->> '$.nombrePostes' as bigint) as nombre_postes,
            cast(record ->> '$.alternance' as boolean) as est_alternance,
            lower({get('search_keyword')}) as mot_cle_recherche
        from ({CLEAN})
    )"""


SILVER_SQL = _silver_sql()
register("silver_layer", lambda spark, d: _silver(spark, d).select(*_SILVER), SILVER_SQL)
register(
    "layer_metrics",
    lambda spark, d: cleaning.layer_metrics(_silver(spark, d)),
    f"""select count(*) as lignes, {', '.join(f'count(*) filter (where {c}) as {c}' for c in (
        'localisation_renseignee', 'coordonnees_renseignees', 'salaire_renseigne',
        'information_entreprise_disponible'))} from ({SILVER_SQL})""",
)


def _unserved(spark, sf_dir):
    return spark.sql(
        """select event_id as id_offre, case event_id % 4 when 0 then 'hier' when 1 then null
            else cast(cast(ts as date) as string) end as date_creation,
            case event_id % 3 when 0 then 'true' when 1 then 'peut-etre' end as est_alternance,
            case event_id % 3 when 0 then cast(event_id as string) when 1 then 'beaucoup' end as nombre_postes,
            case event_id % 3 when 0 then cast('NaN' as double) else value end as latitude,
            array(event_type, cast(null as string)) as horaires_travail from {events}""",
        events=tables.table(spark, sf_dir, "events"))


def _serving(spark, sf_dir):
    return cleaning.serving_types(_unserved(spark, sf_dir), "silver/part.parquet", F.lit("2024-02-01 12:00:00").cast("timestamp"))


register(
    "serving_coercions", _serving,
    """select event_id as id_offre,
        case when event_id % 4 > 1 then strftime(ts::date, '%Y-%m-%d 00:00:00') end as date_creation,
        case when event_id % 3 = 0 then true end as est_alternance,
        case when event_id % 3 = 0 then event_id end as nombre_postes,
        case when event_id % 3 <> 0 then value end as latitude,
        '["' || event_type || '",null]' as horaires_travail, '2024-02-01 12:00:00' as date_chargement,
        'silver/part.parquet' as fichier_source_silver from events""",
)
register("serving_rejects", lambda spark, d: cleaning.coercion_rejects(_unserved(spark, d), ("est_alternance",)),
         check_rows({"est_alternance_illisible": "count(*) filter (where event_id % 3 = 1)"}, "select * from events"))
register(
    "load_contract",
    lambda spark, d: cleaning.load_checks(
        tables.table(spark, d, "orders"), "o_orderkey", {"o_orderstatus": None, "o_orderpriority": "1-URGENT"},
        ("o_orderkey", "o_custkey", "absente")),
    check_rows({"colonnes_absentes": "1", "table_vide": "(count(*) = 0)::int",
                "cles_manquantes": "count(*) - count(o_orderkey)",
                "cles_dupliquees": "count(o_orderkey) - count(distinct o_orderkey)",
                "o_orderstatus_non_unique": "(count(distinct o_orderstatus) <> 1)::int",
                "o_orderpriority_non_unique": "(min(o_orderpriority) <> '1-URGENT' or "
                "max(o_orderpriority) <> '1-URGENT')::int"}, "select * from orders"),
)



def _staged(spark, sf_dir):
    served = cleaning.serving_types(_silver(spark, sf_dir), "silver/part.parquet",
                                    F.lit("2024-02-01 12:00:00").cast("timestamp"))
    staged = enrichment.staging(served)
    return staged.select(
        *[c for c in _SILVER if c in staged.columns], "fichier_source_silver",
        F.lit(len(staged.columns)).alias("colonnes"))


register("staging_view", _staged,
         f"select *, 'silver/part.parquet' as fichier_source_silver, 64 as colonnes from ({SILVER_SQL})")

# Gates


def _raw_and_bronze(spark, sf_dir):
    raw = bronze.parse(clean_records(spark, sf_dir)).select(bronze.field("id").alias("id"), "record")
    return raw, _bronze(spark, sf_dir, clean_records)


def _damaged_bronze(spark, sf_dir):
    """Every rule broken: rows lost, repeated, unreadable, changed, without id, or with other keywords."""
    raw, good = _raw_and_bronze(spark, sf_dir)
    n = F.col("event_id")
    case = n % 100
    bad = good.filter(case != 7).withColumns(
        {
            "raw_record": F.when(case == 8, F.lit("{oops")).when(
                case == 9, F.replace("raw_record", F.lit("CDI"), F.lit("CDD"))).when(
                case == 15, F.replace("raw_record", F.lit('"id":"'), F.lit('"id":"x'))).otherwise(F.col("raw_record")),
            "search_keyword": F.when(case == 10, F.lit("autre")).otherwise(F.col("search_keyword")),
            "ingestion_timestamp": F.when(case != 11, F.col("ingestion_timestamp")),
            "search_keywords": F.when(case != 16, F.col("search_keywords")),
            "id": F.when(case != 12, F.col("id")),
        }
    )
    raw = raw.withColumn("id", F.when(F.col("id").cast("long") % 100 != 13, F.col("id")))
    return gates.bronze_equals_raw(raw, bad.unionByName(bad.filter(case == 14)))


def _silver_and_raw(spark, sf_dir):
    raw, _ = _raw_and_bronze(spark, sf_dir)
    return raw, _silver(spark, sf_dir)


def _damaged_silver_records(spark, sf_dir):
    raw, good = _silver_and_raw(spark, sf_dir)
    case = F.col("id_offre").cast("long") % 100
    return gates.silver_equals_raw(raw, good.filter(case != 7).withColumns({
        "enregistrement_brut": F.when(case == 8, F.lit("{oops")).when(
            case == 9, F.replace("enregistrement_brut", F.lit("CDI"), F.lit("CDD"))).otherwise(F.col("enregistrement_brut")),
        "mots_cles_recherche": F.when(case != 16, F.col("mots_cles_recherche"))}))


def _count_mod(k: int) -> str:
    return f"(select count(*) from events where event_id % 100 = {k})"


_RECORD_RULES = ("ids_nuls_raw", "ids_nuls_bronze", "ids_absents_bronze", "ids_inattendus_bronze", "ids_dupliques",
                 "enregistrement_illisible", "enregistrement_autre_id", "enregistrement_different")
register("silver_gate_records", lambda spark, d: gates.silver_equals_raw(*_silver_and_raw(spark, d)),
         check_rows({n: "0" for n in (*_RECORD_RULES, "search_keywords_different")}, "select 1"))
register(
    "silver_gate_record_defects", _damaged_silver_records,
    check_rows(dict.fromkeys(_RECORD_RULES, "0") | {
        "ids_absents_bronze": _count_mod(7), "enregistrement_illisible": _count_mod(8),
        "enregistrement_different": _count_mod(9), "search_keywords_different": _count_mod(16)}, "select 1"),
)
register(
    "bronze_gate",
    lambda spark, d: gates.bronze_equals_raw(*_raw_and_bronze(spark, d)),
    check_rows({n: "0" for n in (*_RECORD_RULES, "search_keyword_different", "search_keywords_different",
                                 "ingestion_timestamp_different")}, "select 1"),
)
register(
    "bronze_gate_defects", _damaged_bronze,
    check_rows({
        "ids_nuls_raw": _count_mod(13), "ids_nuls_bronze": _count_mod(12),
        "ids_absents_bronze": f"{_count_mod(7)} + {_count_mod(12)}", "ids_inattendus_bronze": _count_mod(13),
        "ids_dupliques": _count_mod(14), "enregistrement_illisible": _count_mod(8),
        "enregistrement_autre_id": _count_mod(15), "enregistrement_different": f"{_count_mod(9)} + {_count_mod(15)}",
        "search_keyword_different": _count_mod(10), "search_keywords_different": _count_mod(16),
        "ingestion_timestamp_different": _count_mod(11)}, "select 1"),
)
register(
    "drift_gate",
    lambda spark, d: gates.drift_coherent(bronze.schema_drift(bronze.parse(records(spark, d))), True, 2),
    check_rows({"derive_declaree": "0",
                "derive_constatee": f"(count(distinct champ) filter (where not bloquant) <> 2)::int"},
               _drift_sql()),
)


def _damaged_silver(spark, sf_dir):
    n = F.col("id_offre").cast("long")
    df = _silver(spark, sf_dir)
    bad = df.withColumns({
        "entreprise_renseignee": F.when(n % 100 != 3, F.col("entreprise_renseignee")),
        "salaire_renseigne": F.when(n % 100 == 4, ~F.col("salaire_renseigne")).otherwise(F.col("salaire_renseigne")),
        "periode_salaire": F.when(n % 100 == 5, F.lit("Horaire")).otherwise(F.col("periode_salaire")),
        "date_actualisation_coherente": F.when(n % 100 != 6, F.col("date_actualisation_coherente")),
    })
    return gates.silver_indicators(bad)


_INDICATORS = ("date_actualisation_coherente_incoherent", "entreprise_renseignee_nul",
               "entreprise_renseignee_incoherent", "description_entreprise_renseignee_nul",
               "description_entreprise_renseignee_incoherent", "information_entreprise_disponible_nul",
               "information_entreprise_disponible_incoherent", "salaire_renseigne_nul",
               "salaire_renseigne_incoherent", "periode_salaire_incoherent", "coordonnees_renseignees_nul",
               "coordonnees_renseignees_incoherent", "localisation_renseignee_nul",
               "localisation_renseignee_incoherent")
register("silver_gate", lambda spark, d: gates.silver_indicators(_silver(spark, d)),
         check_rows({n: "0" for n in _INDICATORS}, "select 1"))
register(
    "silver_gate_defects", _damaged_silver,
    check_rows({n: {"entreprise_renseignee_nul": _count_mod(3), "salaire_renseigne_incoherent": _count_mod(4),
                    "periode_salaire_incoherent": _count_mod(5),
                    "date_actualisation_coherente_incoherent": _count_mod(6)}.get(n, "0")
                for n in _INDICATORS}, "select 1"),
)
register(
    "silver_gate_keywords",
    lambda spark, d: gates.keyword_checks(_silver(spark, d)).unionByName(gates.technical_dates(_silver(spark, d))),
    check_rows({n: "0" for n in ("liste_invalide", "mot_cle_hors_liste", "date_ingestion_non_unique",
                                 "date_traitement_silver_non_unique")}, "select 1"),
)
register(
    "lineage_gate",
    lambda spark, d: gates.lineage_checks(_silver(spark, d), {
        "batch_id": "batch_1", "bronze_processing_run_id": "run_1", "processing_run_id": "run_2",
        "objet_source_raw": "autre"}),
    check_rows({"batch_id_incoherent": "0", "bronze_processing_run_id_incoherent": "0",
                "processing_run_id_incoherent": "0", "objet_source_raw_incoherent": "1"}, "select 1"),
)
