"""Profiles, reconciliation, data tests and generic aggregates on the provided tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamis.functions import rates
from tamis.operators import aggregates, bronze, checks, cleaning, dimension, gates, identity, marts, profiles
from tamis.plans import layer_queries as layers
from tamis.plans import oracle_sql as sql
from tamis.plans import tables
from tamis.plans.layer_queries import check_rows
from tamis.plans.registry import register
from tamis.presets import acquisition, rules, silver
from tamis.sources import runs


def _table(name: str):
    return lambda spark, d: tables.table(spark, d, name)


# Profiles

_GAPS = r"""select doc_id, case when doc_id % 5 = 0 then null when doc_id % 7 = 0 then '  ' else lang end as lang,
    case when doc_id % 3 = 0 then source end as source, n_chars, text from {documents}"""
_GAPS_SQL = _GAPS.replace("{documents}", "documents")


def _gaps(spark, sf_dir):
    return spark.sql(_GAPS, documents=tables.table(spark, sf_dir, "documents"))


def _missing(column: str) -> str:
    return f"count(*) filter (where trim(coalesce({column}::varchar, '')) = '')"


def _column_rows(columns) -> str:
    return " union all ".join(
        f"select {i} as ordre, '{c}' as colonne, count(*) as lignes, {_missing(c)} as m from ({_GAPS_SQL})"
        for i, c in enumerate(columns, 1)
    )


_DOC = ("doc_id", "lang", "source", "n_chars", "text")
register(
    "profile_completeness",
    lambda spark, d: profiles.completeness(_gaps(spark, d)),
    f"""select colonne, lignes - m as available_count, m as missing_count,
        {sql.rate('lignes - m', 'lignes')} as completeness_rate from ({_column_rows(_DOC)})""",
)
register(
    "profile_missing_ranking",
    lambda spark, d: profiles.missing_ranking(_gaps(spark, d)),
    f"""select colonne, ordre, m as manquant, lignes - m as present, {sql.rate('m', 'lignes')} as taux_manquant,
        {sql.rate('lignes - m', 'lignes')} as taux_present from ({_column_rows(_DOC)})""",
)

_TEXTS = r"""select event_id,
    case when event_id % 10 = 0 then substr(props, 2) when event_id % 11 = 0 then '' when event_id % 13 = 0 then null
        else props end as props,
    case when event_id % 9 = 0 then '2024-13-45' when event_id % 8 = 0 then ' ' when event_id % 7 = 0 then null
        else cast(cast(ts as date) as string) end as jour, ts from {events}"""
_TEXTS_SQL = _TEXTS.replace("{events}", "events")


def _texts(spark, sf_dir):
    return spark.sql(_TEXTS, events=tables.table(spark, sf_dir, "events"))


def _validity_sql(column: str, valid: str) -> str:
    return f"""select '{column}' as colonne, v as valid_count, n - v - m as invalid_count, m as missing_count,
        {sql.rate('v', '(n - m)')} as validity_rate from (select count(*) as n, {_missing(column)} as m,
        count(*) filter (where trim({column}) <> '' and {valid}) as v from ({_TEXTS_SQL}))"""


register("profile_json_validity", lambda spark, d: profiles.json_validity(_texts(spark, d), ["props"]),
         _validity_sql("props", "json_valid(props)"))
register("profile_json_examples", lambda spark, d: profiles.invalid_json_examples(_texts(spark, d), "props", "event_id"),
         f"""select event_id, props from ({_TEXTS_SQL}) where trim(props) <> '' and not json_valid(props)
             order by event_id limit 3""")
register("profile_date_validity", lambda spark, d: profiles.date_validity(_texts(spark, d), ["jour"]),
         _validity_sql("jour", "try_cast(trim(jour) as timestamp) is not null"))
register(
    "profile_date_ranges",
    lambda spark, d: profiles.date_ranges(
        tables.table(spark, d, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderdate"))),
        ["o_orderdate", "absente"]).drop("type"),
    f"""select 'o_orderdate' as colonne, true as presente, count(*) filter (where o_orderkey % 4 = 0)
        as valeurs_manquantes, {sql.stamp('min(o_orderdate) filter (where o_orderkey % 4 > 0)')} as date_min,
        {sql.stamp('max(o_orderdate) filter (where o_orderkey % 4 > 0)')} as date_max from orders
        union all select 'absente', false, null, null, null""",
)
register("profile_distribution", lambda spark, d: profiles.distribution(_gaps(spark, d), "lang"),
         f"""select coalesce(nullif(trim(lang), ''), 'NULL') as valeur, count(*) as nombre from ({_GAPS_SQL}) group by 1""")
register("profile_top_values", lambda spark, d: profiles.top_values(_gaps(spark, d), "source"),
         f"""select coalesce(nullif(source, ''), 'Non renseigné') as valeur, count(*) as nombre from ({_GAPS_SQL})
             group by 1 order by nombre desc, valeur limit 15""")
register(
    "profile_distributions",
    lambda spark, d: profiles.distributions(tables.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"]),
    """select 'o_orderstatus' as colonne, o_orderstatus as valeur, count(*) as nombre from orders group by 2
       union all select 'o_orderpriority', o_orderpriority, count(*) from orders group by 2""",
)
register("profile_volume",
         lambda spark, d: profiles.volume_delta(tables.table(spark, d, "orders"), tables.table(spark, d, "lineitem")),
         """select a as lignes_avant, b as lignes_apres, a - b as ecart_lignes, 6 as colonnes_avant, 11 as colonnes_apres
            from (select (select count(*) from orders) as a, (select count(*) from lineitem) as b)""")
register("profile_keys", lambda spark, d: profiles.key_report(layers.hits(spark, d), "id"),
         f"""select count(*) filter (where id is null or trim(id) = '') as manquants, count(distinct id) as uniques,
             count(*) - count(distinct id) - max((id is null)::int) as doublons from ({layers.HITS})""")
register(
    "profile_column_contract",
    lambda spark, d: profiles.column_contract(_gaps(spark, d), ["doc_id", "lang", "titre"], ["n_chars", "note"]),
    f"""select 'doc_id' as colonne, 'critique' as groupe, true as presente, 0 as valeurs_manquantes
        union all select 'lang', 'critique', true, {_missing('lang')} from ({_GAPS_SQL})
        union all select 'titre', 'critique', false, null union all select 'n_chars', 'calculee', true, null
        union all select 'note', 'calculee', false, null""",
)
_FLAGS = ("information_entreprise_disponible", "salaire_renseigne", "coordonnees_renseignees", "localisation_renseignee")
register(
    "profile_presence_rates",
    lambda spark, d: profiles.presence_rates(tables.offers(spark, d), {c: F.col(c) for c in _FLAGS}),
    " union all ".join(
        f"""select '{c}' as indicateur, count(*) filter (where {c}) as nombre,
        {sql.rate(f'count(*) filter (where {c})', 'count(*)')} as taux from ({sql.SILVER})""" for c in _FLAGS),
)


def _verdict(spark, sf_dir):
    df = _texts(spark, sf_dir)
    return checks.verdict(profiles.silver_verdict(df, "event_id", ["event_id", "titre"], ["jour"], ["jour"], ["props"]))


register(
    "profile_verdict", _verdict,
    """select 'A_CONTROLER' as statut, 3 as nombre_problemes,
       'colonne_absente_titre, dates_manquantes_jour, json_invalide_props' as problemes from events limit 1""",
)

# Reconciliation

_COPY = r"""select c_custkey, c_name, c_nationkey,
    case when c_custkey % 50 = 1 then c_acctbal + 1 else c_acctbal end as c_acctbal,
    case when c_custkey % 60 = 2 then null else c_mktsegment end as c_mktsegment
    from {customer} where c_custkey % 70 <> 3
    union all select -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from {customer} where c_custkey % 80 = 4"""


def _copy(spark, sf_dir):
    customer = tables.table(spark, sf_dir, "customer")
    return customer, spark.sql(_COPY, customer=customer)


_STATUS = f"""select coalesce(a.c_custkey, b.c_custkey)::varchar as id,
    case when b.c_custkey is null then 'absent' when a.c_custkey is null then 'en_trop'
        when a.c_acctbal = b.c_acctbal and a.c_mktsegment is not distinct from b.c_mktsegment then 'identique'
        else 'different' end as statut
    from customer a full join ({_COPY.replace('{customer}', 'customer')}) b on a.c_custkey = b.c_custkey"""
register("compare_rows_changed", lambda spark, d: identity.changed_rows(*_copy(spark, d), "c_custkey", buckets=256),
         f"select * from ({_STATUS}) where statut <> 'identique'")
register("compare_rows", lambda spark, d: identity.compare_rows(*_copy(spark, d), "c_custkey"), _STATUS)
register(
    "compare_rows_summary",
    lambda spark, d: identity.comparison_summary(identity.compare_rows(*_copy(spark, d), "c_custkey")),
    f"""with s as ({_STATUS}) select count(*) filter (where statut in ('identique', 'different')) as lignes_comparees,
        count(*) filter (where statut = 'different') as lignes_differentes,
        count(*) filter (where statut = 'absent') as ids_absents,
        count(*) filter (where statut = 'en_trop') as ids_en_trop,
        (select string_agg(id, ',' order by id) from (select id from s where statut = 'different' order by id limit 10))
            as exemples_differents,
        bool_and(statut = 'identique') as contenu_identique from s""",
)
register(
    "layer_identity",
    lambda spark, d: identity.layer_identity({
        "commandes": (tables.table(spark, d, "orders"), "o_orderkey"),
        "lignes": (tables.table(spark, d, "lineitem"), "l_orderkey"),
        "clients": (tables.table(spark, d, "customer"), "c_custkey")}),
    check_rows(
        {"ids_incomplets": "count(*) filter (where a = 0 or b = 0 or c = 0)"}
        | {f"{k}_{name}": e for name, x in (("commandes", "a"), ("lignes", "b"), ("clients", "c"))
           for k, e in (("lignes", f"sum({x})"), ("ids", f"count(*) filter (where {x} > 0)"), ("ids_nuls", "0"),
                        ("ids_dupliques", f"sum(greatest({x} - 1, 0))"), ("ids_absents", f"count(*) filter (where {x} = 0)"))},
        """select id, count(*) filter (where k = 1) as a, count(*) filter (where k = 2) as b,
            count(*) filter (where k = 3) as c from (select o_orderkey as id, 1 as k from orders
            union all select l_orderkey, 2 from lineitem union all select c_custkey, 3 from customer) group by id"""),
)
register(
    "id_reconciliation",
    lambda spark, d: identity.id_examples(*[
        (t, k) for t, k in ((tables.table(spark, d, "orders"), "o_orderkey"), (tables.table(spark, d, "lineitem"), "l_orderkey"))]),
    """with e as (select 'absent' as ecart, o_orderkey::varchar as id from orders
            where o_orderkey not in (select l_orderkey from lineitem)
        union select 'en_trop', l_orderkey::varchar from lineitem where l_orderkey not in (select o_orderkey from orders))
       select ecart, count(*) as nombre, array_to_string(list(id order by id)[1:10], ',') as exemples from e group by ecart""",
)
_STORED = ("batch_id", "processing_run_id", "silver_schema_version", "fichier_source_silver")
register(
    "target_metrics",
    lambda spark, d: identity.target_metrics(tables.offers(spark, d), "id_offre", _STORED, "date_chargement"),
    f"""select count(*) as nombre_lignes, count(distinct id_offre) as ids_distincts,
        count(*) - count(id_offre) as ids_manquants, 0 as ids_dupliques,
        count(*) - count(date_chargement) as date_chargement_manquants,
        {', '.join(f'count(distinct {c}) as nombre_{c}, min({c}) as {c}_min, max({c}) as {c}_max' for c in _STORED)},
        count(distinct date_chargement) as nombre_date_chargement,
        {sql.stamp('min(date_chargement)')} as date_chargement_min, {sql.stamp('max(date_chargement)')} as date_chargement_max
        from ({sql.SILVER})""",
)


def _matrix(spark, sf_dir):
    """A load of the derived silver layer: one batch, one lost row, one changed value.

    The layer is a table, as in a run: six reads of it parse no record again.
    """
    source = tables.stored(spark, sf_dir, "silver_load", lambda: layers._silver(spark, sf_dir).withColumns({
        "fichier_source_silver": F.lit("silver/part.parquet"),
        "date_chargement": F.lit("2024-02-01 12:00:00").cast("timestamp")}))
    target = source.filter(F.col("id_offre") != "17").withColumn(
        "description_offre", F.when(F.col("id_offre") == "18", "autre").otherwise(F.col("description_offre")))
    expected = {
        "rows": source.count(), "batch_id": "batch_1", "processing_run_id": "run_2", "silver_schema_version": "2.0.0",
        "fichier_source_silver": "silver/part.parquet", "source_sha256": "abc"}
    audit = source.agg(F.count(F.lit(1)).alias("source_row_count"), F.count(F.lit(1)).alias("loaded_row_count")).select(
        "*", *[F.lit(v).alias(n) for n, v in (
            ("status", "SUCCESS"), ("batch_id", "batch_1"), ("processing_run_id", "run_2"),
            ("source_object_key", "silver/part.parquet"), ("source_sha256", "abc"), ("silver_schema_version", "2.0.0"),
            ("git_commit_sha", "c0ffee"), ("git_branch", "main"), ("git_worktree_dirty", False))])
    shared = [c for c in source.columns if c in target.columns]
    compared = identity.compare_rows(source, target, "id_offre", shared)
    return gates.load_matrix(
        identity.target_metrics(target, "id_offre", _STORED, "date_chargement"),
        identity.comparison_summary(compared),
        identity.layer_identity({"s": (source, "id_offre"), "t": (target, "id_offre")}),
        identity.compare_schemas(source, target, silver.SERVING_EXTRA), audit, expected, staging_left=False)


_BROKEN = ("nombre_lignes_identique", "ids_distincts_identiques", "ensembles_ids_identiques", "contenu_identique")
_MATRIX = (
    "silver_non_vide nombre_lignes_identique ids_distincts_identiques ids_non_nuls ids_non_dupliques "
    "ensembles_ids_identiques schema_valide batch_unique batch_id_identique processing_run_unique "
    "processing_run_id_identique silver_schema_version_unique silver_schema_version_identique source_silver_unique "
    "source_silver_identique date_chargement_non_nulle date_chargement_unique contenu_identique audit_present "
    "audit_success audit_batch_id_identique audit_processing_run_identique audit_source_object_identique "
    "audit_sha256_identique audit_volume_source_identique audit_volume_charge_identique audit_schema_version_identique "
    "audit_git_commit_present audit_git_branch_presente audit_git_worktree_clean table_intermediaire_absente").split()
register("load_check_matrix", _matrix,
         " union all ".join(f"select '{n}' as controle, {str(n not in _BROKEN).lower()} as ok" for n in _MATRIX))
register("load_status", lambda spark, d: gates.load_status(_matrix(spark, d)),
         f"select 'NON_VALIDE' as statut, {len(_MATRIX) - len(_BROKEN)} as controles_valides, {len(_MATRIX)} as controles")

register(
    "schema_reconciliation",
    lambda spark, d: identity.schema_rows(
        tables.table(spark, d, "customer"),
        tables.table(spark, d, "customer").drop("c_nationkey").selectExpr("*", "1 as date_chargement", "2 as surplus"),
        silver.SERVING_EXTRA),
    """select column_name as colonne, case when column_name = 'c_nationkey' then 'absente' else 'commune' end as etat
        from (describe customer) union all values ('date_chargement', 'technique'),
        ('fichier_source_silver', 'technique_absente'), ('surplus', 'inattendue')""",
)

# Generic aggregates

_LINES = r"""select l_returnflag, case when l_orderkey % 100 <> 1 then l_orderkey end as l_orderkey, l_suppkey, l_quantity,
    case when l_linenumber > 1 then l_linestatus = 'O' end as ouverte, cast(l_linenumber as bigint) as rang,
    l_shipdate, 'lot_' || l_linestatus as lot from {lineitem}"""


def _lines(spark, sf_dir):
    return spark.sql(_LINES, lineitem=tables.table(spark, sf_dir, "lineitem"))


def _distinct(spark, sf_dir):
    counted = aggregates.distinct_counts(
        _lines(spark, sf_dir), ["l_returnflag"], "l_orderkey",
        {"grandes": F.col("l_quantity") > 25, "ouvertes": F.coalesce("ouverte", F.lit(False)),
         "non_ouvertes": ~F.coalesce("ouverte", F.lit(False))},
        means={"rang_moyen": F.col("rang")}, covered={"fournisseurs": F.col("l_suppkey")},
        lineage={"lot": F.col("lot"), "dernier_envoi": F.col("l_shipdate")}, total="commandes")
    return counted.select(
        "l_returnflag", "commandes", "grandes", "ouvertes", "non_ouvertes", "fournisseurs", "lot", "dernier_envoi",
        rates.mean(F.col("rang_moyen_somme"), F.col("rang_moyen_nombre")).alias("rang_moyen"),
        rates.share(F.col("grandes"), F.col("commandes")).alias("part_grandes"))


register(
    "conditional_distinct_counts", _distinct,
    f"""select *, {sql.share('grandes', 'commandes')} as part_grandes from (
        select l_returnflag, count(distinct l_orderkey) as commandes,
        count(distinct l_orderkey) filter (where l_quantity > 25) as grandes,
        count(distinct l_orderkey) filter (where ouverte) as ouvertes,
        count(distinct l_orderkey) filter (where ouverte is not true) as non_ouvertes,
        count(distinct l_suppkey) as fournisseurs, max(lot) as lot, {sql.stamp('max(l_shipdate)')} as dernier_envoi,
        {sql.mean('rang')} as rang_moyen from ({_LINES.replace('{lineitem}', 'lineitem')}) group by 1)""",
)
register(
    "guarded_share",
    lambda spark, d: tables.table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n"),
        F.count_if(F.col("o_orderpriority") != "5-LOW").alias("d"),
    ).select("o_orderpriority", rates.share(F.col("n"), F.col("d")).alias("part")),
    f"""select o_orderpriority, {sql.share("count(*) filter (where o_orderstatus = 'F')",
        "count(*) filter (where o_orderpriority <> '5-LOW')")} as part from orders group by 1""",
)
_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
register(
    "exact_quantiles",
    lambda spark, d: aggregates.exact_quantiles(
        tables.table(spark, d, "lineitem").withColumn("centimes", F.expr(_CENTS)),
        ["l_returnflag", "l_linestatus"], "centimes", {"q25": 0.25, "mediane": 0.5, "q75": 0.75},
        where=F.col("l_quantity") > 10),
    f"""select l_returnflag, l_linestatus, quantile_cont({_CENTS}::double, 0.25) as q25,
        quantile_cont({_CENTS}::double, 0.5) as mediane, quantile_cont({_CENTS}::double, 0.75) as q75
        from lineitem where l_quantity > 10 group by all""",
)
register(
    "filtered_statistics",
    lambda spark, d: aggregates.filtered_stats(
        tables.table(spark, d, "lineitem").withColumn("centimes", F.expr(_CENTS)),
        ["l_suppkey"], "centimes", F.col("l_returnflag") == "R"),
    f"""select l_suppkey, cast(sum({_CENTS}) filter (where l_returnflag = 'R') as bigint) as somme,
        count(*) filter (where l_returnflag = 'R') as nombre, min({_CENTS}) filter (where l_returnflag = 'R') as minimum,
        max({_CENTS}) filter (where l_returnflag = 'R') as maximum from lineitem group by 1""",
)
register(
    "many_to_one_join",
    lambda spark, d: dimension.many_to_one(
        tables.table(spark, d, "customer").withColumn("cle", F.col("c_nationkey") * 2),
        tables.table(spark, d, "nation").withColumnRenamed("n_nationkey", "cle"), "cle"
    ).select("c_custkey", "cle", "n_name", "n_regionkey"),
    """select c_custkey, c_nationkey * 2 as cle, n_name, n_regionkey from customer
       left join nation on n_nationkey = c_nationkey * 2""",
)

# Data tests


def _generic(spark, sf_dir):
    df = tables.table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 8 > 0, F.col("o_orderdate")))
    return checks.generic_tests(df, ["o_orderkey", "o_orderdate"], ["o_orderkey", "o_custkey"],
                                {"o_orderstatus": ["O", "F"]})


register(
    "test_generic", _generic,
    check_rows({
        "not_null_o_orderkey": "count(*) - count(o_orderkey)",
        "not_null_o_orderdate": "count(*) filter (where o_orderkey % 8 = 0)",
        "accepted_values_o_orderstatus": "count(*) filter (where o_orderstatus not in ('O', 'F'))",
        "unique_o_orderkey": "0",
        "unique_o_custkey": "(select count(*) from (select o_custkey from orders group by 1 having count(*) > 1))",
    }, "select * from orders"),
)
register(
    "test_duplicates",
    lambda spark, d: checks.duplicated(tables.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "select l_orderkey, l_linenumber, count(*) as nombre_lignes from lineitem group by all having count(*) > 1",
)
register(
    "test_referential",
    lambda spark, d: checks.orphans(
        tables.table(spark, d, "customer").withColumn("code", F.col("c_nationkey") + 7),
        tables.table(spark, d, "nation"), "code", "n_nationkey"),
    "select distinct c_nationkey + 7 as code from customer where c_nationkey + 7 not in (select n_nationkey from nation)",
)
register(
    "test_area_codes",
    lambda spark, d: checks.orphans(tables.enriched(spark, d), dimension.preset_reference(spark),
                                    "code_departement", "code_departement"),
    f"""select distinct code_departement from ({sql.ENRICHED}) where code_departement is not null
        and code_departement not in (select code_departement from ({sql.REFERENCE}))""",
)

_MARTS = {
    "famille": (lambda spark, d: marts.by_family(tables.combined(spark, d)), sql.BY_FAMILY),
    "contrat": (lambda spark, d: marts.by_contract(tables.combined(spark, d)), sql.BY_CONTRACT),
    "departement": (lambda spark, d: marts.by_area(tables.combined(spark, d)), sql.BY_AREA),
    "region": (lambda spark, d: marts.by_region(tables.combined(spark, d)), sql.BY_REGION),
}
_FAMILIES = [f"nombre_offres_{p}" for p in marts.FAMILY_MEASURES]


# Rounded shares of few groups add up to 100 closely; of a hundred areas less so.
_TOLERANCE = {"famille": (99.9, 100.1), "contrat": (99.9, 100.1), "departement": (99.5, 100.5), "region": (99.5, 100.5)}


def _mart_tests(name: str, build, mart_sql: str) -> None:
    has_families = name != "famille"
    low, high = _TOLERANCE[name]

    def query(spark, sf_dir):
        mart = tables.stored(spark, sf_dir, f"mart_{name}", lambda: build(spark, sf_dir).drop("date_calcul_kpi"))
        total = tables.enriched(spark, sf_dir).agg(F.count_distinct("id_offre").alias("total"))
        parts = checks.parts_of_total(mart, _FAMILIES, "nombre_offres") if has_families else mart.limit(0)
        return (
            mart.agg(F.sum("nombre_offres").alias("somme_detail"), F.sum("part_offres_pct").alias("total_part_pct"))
            .crossJoin(total)
            .crossJoin(parts.agg(F.count(F.lit(1)).alias("parts_incoherentes")))
            .crossJoin(checks.share_sum(mart, "part_offres_pct", low, high).agg(F.count(F.lit(1)).alias("parts_hors_tolerance")))
            .crossJoin(checks.compare_totals(mart, "nombre_offres", total, "total").agg(
                F.count(F.lit(1)).alias("totaux_differents")))
        )

    wrong = f"count(*) filter (where {' + '.join(_FAMILIES)} <> nombre_offres)" if has_families else "0"
    register(
        f"test_mart_{name}", query,
        f"""with m as ({mart_sql}) select cast(sum(nombre_offres) as bigint) as somme_detail,
            round(sum(part_offres_pct), 2) as total_part_pct, (select count(distinct id_offre) from ({sql.SILVER})) as total,
            {wrong} as parts_incoherentes,
            (round(sum(part_offres_pct), 2) not between {low} and {high})::int as parts_hors_tolerance,
            (sum(nombre_offres) <> (select count(distinct id_offre) from ({sql.SILVER})))::int as totaux_differents from m""",
    )


for _name, (_build, _mart) in _MARTS.items():
    _mart_tests(_name, _build, _mart)

register(
    "test_reference_labels",
    lambda spark, d: checks.long_form(
        marts.by_area(tables.combined(spark, d)),
        {"departements_sans_libelle": F.count_if((F.col("code_departement") != "NON_RENSEIGNE") & (
            F.col("nom_departement") == "Non renseigné"))}),
    check_rows({"departements_sans_libelle": """count(distinct code_departement) filter (where code_departement not in
        (select code_departement from ref))"""},
               f"select * from ({sql.ENRICHED})").replace("unpivot", f"with ref as ({sql.REFERENCE}) unpivot", 1),
)

_FIVE = ("nombre_offres", "nombre_salaires_renseignes", "nombre_salaires_exploitables",
         "nombre_salaires_suspects", "nombre_salaires_non_exploitables")


def _salary_mart(spark, sf_dir):
    return tables.stored(spark, sf_dir, "mart_salaires", lambda: marts.salary_analysis(
        tables.salary_facts(spark, sf_dir), combined=tables.combined(spark, sf_dir)).drop("date_calcul_kpi"))


def _both(good, damaged, test):
    """The test on a mart and on a damaged copy of it."""
    states = [test(df).select(F.lit(state).alias("etat"), "*") for state, df in (("mart", good), ("abime", damaged))]
    return states[0].unionByName(states[1])


def _axes(spark, sf_dir):
    mart = _salary_mart(spark, sf_dir)
    wrong = (F.col("axe_analyse") == "Type de contrat") & (F.col("rang_modalite") == 1)
    damaged = mart.withColumn("nombre_offres", F.col("nombre_offres") + F.when(wrong, 1).otherwise(0))
    return _both(mart, damaged, lambda df: checks.axis_violations(df, "axe_analyse", "Global", _FIVE))


register(
    "test_salary_axes", _axes,
    f"""with m as ({sql.SALARY_ANALYSIS}),
        e as (select 'mart' as etat, axe_analyse, {', '.join(_FIVE)} from m union all
            select 'abime', axe_analyse, nombre_offres + (axe_analyse = 'Type de contrat' and rang_modalite = 1)::int,
                {', '.join(_FIVE[1:])} from m),
        l as ({' union all '.join(f"select etat, axe_analyse, '{c}' as mesure, {c} as v from e" for c in _FIVE)}),
        s as (select etat, axe_analyse, mesure, sum(v)::bigint as somme from l group by all)
        select s.etat, s.axe_analyse, s.mesure, s.somme, g.somme as attendu from s
        join s g on g.etat = s.etat and g.mesure = s.mesure and g.axe_analyse = 'Global'
        where s.axe_analyse <> 'Global' and s.somme <> g.somme""",
)


def _region_labels(spark, sf_dir):
    mart = tables.stored(spark, sf_dir, "mart_region", lambda: _MARTS["region"][0](spark, sf_dir).drop("date_calcul_kpi"))
    damaged = mart.withColumn("nom_region", F.when(F.col("rang_region") > 2, F.col("nom_region")))
    return _both(mart, damaged, lambda df: checks.unlabelled(
        df, "code_region", "nom_region", rules.NO_REGION, rules.UNKNOWN))


register(
    "test_region_labels", _region_labels,
    f"""with m as ({sql.BY_REGION}), e as (select 'mart' as etat, code_region, nom_region from m union all
        select 'abime', code_region, case when rang_region > 2 then nom_region end from m)
        select etat, code_region from e where code_region <> '{rules.NO_REGION}'
        and (nom_region is null or nom_region = '{rules.UNKNOWN}')""",
)


def _kpi_row(spark, sf_dir):
    mart = tables.stored(spark, sf_dir, "mart_marche", lambda: marts.market_kpis(
        tables.combined(spark, sf_dir)).drop("date_calcul_kpi"))
    damaged = mart.unionByName(mart.withColumn("nombre_total_offres", F.lit(0).cast("long")))
    return _both(mart, damaged, lambda df: checks.one_positive_row(df, "nombre_total_offres"))


register(
    "test_kpi_row", _kpi_row,
    f"""with m as (select nombre_total_offres as n from ({sql.KPI})),
        e as (select 'mart' as etat, n from m union all select 'abime', n from m union all select 'abime', 0 from m)
        select etat, 'nombre_de_lignes' as controle, (count(*) <> 1)::int as violations from e group by etat
        union all select etat, 'volume_non_positif', count(*) filter (where coalesce(n, 0) <= 0) from e group by etat""",
)


def _salary_mart_rules(spark, sf_dir):
    mart, n = _salary_mart(spark, sf_dir), F.col
    order = [n(c) for c in ("salaire_annuel_min_observe", "premier_quartile", "salaire_annuel_median",
                            "troisieme_quartile", "salaire_annuel_max_observe")]
    ordered = F.lit(True)
    for a, b in zip(order, order[1:]):
        ordered = ordered & F.coalesce(a <= b, F.lit(False))
    return checks.long_form(mart, {
        "distribution_incoherente": F.count_if((n("nombre_salaires_exploitables") > 0) & ~ordered),
        "comptes_incoherents": F.count_if(
            (n("nombre_salaires_renseignes") > n("nombre_offres"))
            | (n("nombre_salaires_exploitables") + n("nombre_salaires_non_exploitables") != n("nombre_salaires_renseignes"))),
        "modalites_dupliquees": F.count(F.lit(1)) - F.count_distinct("axe_analyse", "code_modalite"),
        "modalites": F.count(F.lit(1)),
    })


register("test_salary_mart", _salary_mart_rules,
         check_rows({"distribution_incoherente": "0", "comptes_incoherents": "0", "modalites_dupliquees": "0",
                     "modalites": "count(*)"}, sql.SALARY_ANALYSIS))


def _salary_rules(spark, sf_dir):
    n, usable = F.col, F.col("salaire_exploitable")
    return checks.long_form(tables.salary_layer(spark, sf_dir), {
        "exploitables_incoherents": F.count_if(usable & (
            n("salaire_suspect") | ~n("periode_extraite").isin("Annuel", "Mensuel") | n("salaire_annuel_central").isNull()
            | (n("salaire_annuel_min") <= 0) | (n("salaire_annuel_max") < n("salaire_annuel_min")))),
        "horaires_exploitables": F.count_if(usable & (n("periode_extraite") == "Horaire")),
        "suspects_exploitables": F.count_if(usable & n("salaire_suspect")),
        "non_parses": F.count_if(~n("salaire_parse_ok")),
        "periodes_incoherentes": F.count_if(~n("periode_salaire_coherente")),
        "lignes": F.count(F.lit(1)),
    })


register("test_salary_rules", _salary_rules, check_rows({
    "exploitables_incoherents": "0", "horaires_exploitables": "0", "suspects_exploitables": "0",
    "non_parses": "count(*) filter (where not salaire_parse_ok)",
    "periodes_incoherentes": "count(*) filter (where not periode_salaire_coherente)", "lignes": "count(*)"},
    sql.salaries_sql()))


def _sources(spark, sf_dir):
    glob = _salary_mart(spark, sf_dir).filter("axe_analyse = 'Global'").select(*[F.col(c).alias(f"mart_{c}") for c in _FIVE[:4]])
    offers = tables.enriched(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("nombre_offres"), F.count_if("salaire_renseigne").alias("nombre_salaires_renseignes"))
    pay = tables.salary_layer(spark, sf_dir).agg(
        F.count_if("salaire_exploitable").alias("nombre_salaires_exploitables"),
        F.count_if("salaire_suspect").alias("nombre_salaires_suspects"), F.count(F.lit(1)).alias("lignes_normalisees"))
    return glob.crossJoin(offers).crossJoin(pay)


register(
    "test_salary_sources", _sources,
    f"""with s as ({sql.salaries_sql()}), o as ({sql.SILVER})
        select a as nombre_offres, a as mart_nombre_offres, b as nombre_salaires_renseignes,
        b as mart_nombre_salaires_renseignes, c as nombre_salaires_exploitables, c as mart_nombre_salaires_exploitables,
        d as nombre_salaires_suspects, d as mart_nombre_salaires_suspects, e as lignes_normalisees from (
        select (select count(*) from o) as a, (select count(*) from o where salaire_renseigne) as b,
        (select count(*) from s where salaire_exploitable) as c, (select count(*) from s where salaire_suspect) as d,
        (select count(*) from s) as e)""",
)


def _run_metrics(spark, sf_dir):
    source = layers.clean_records
    parsed = bronze.parse(source(spark, sf_dir))
    silver_df = layers._silver(spark, sf_dir)
    return runs.run_metrics(
        {"raw": parsed, "bronze": layers._bronze(spark, sf_dir, source), "silver": silver_df,
         "serving": cleaning.serving_types(silver_df, "k", F.lit("2024-02-01 12:00:00").cast("timestamp"))},
        "id_offre", bronze.schema_drift(parsed), runs.RATE_METRICS, build_ok=True)


_N = "(select count(*)::double from events)"


def _silver_rate(flag: str) -> str:
    return f"(select {sql.rate(f'count(*) filter (where {flag})', 'count(*)')} from ({layers.SILVER_SQL}))"


# event_id, nested, text, other typed, JSON, one extra key, the record and five lineage columns
_BRONZE_COLUMNS = 1 + 12 + len(acquisition.TEXT_FIELDS) + 6 + len(acquisition.JSON_FIELDS) + 1 + 1 + 5
register("run_metrics", _run_metrics, " union all ".join(
    f"select '{layer}' as layer, '{name}' as metric_name, {value}::double as metric_value, '{unit}' as metric_unit"
    for layer, name, value, unit in (
        ("RAW", "row_count", _N, "count"), ("BRONZE", "row_count", _N, "count"),
        ("BRONZE", "unique_id_count", _N, "count"), ("BRONZE", "column_count", str(_BRONZE_COLUMNS), "count"),
        ("BRONZE", "schema_drift_field_count", "0", "count"), ("BRONZE", "schema_drift_detected", "0", "boolean"),
        ("SILVER", "row_count", _N, "count"), ("SILVER", "unique_id_count", _N, "count"),
        ("SILVER", "column_count", "72", "count"),
        *[("SILVER", m, _silver_rate(c), "percent") for m, c in runs.RATE_METRICS.items()],
        ("POSTGRES", "row_count", _N, "count"), ("DBT", "build_success", "1", "boolean"))))
