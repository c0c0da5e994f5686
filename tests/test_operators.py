"""Operators against brute force on small random tables, and corruption tests of the gates."""

import random
from datetime import datetime
from decimal import Decimal

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tamis.operators import aggregates, bronze, checks, cleaning, dimension, gates, identity, marts, merge, profiles


def long(df):
    return {r["controle"]: r["violations"] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_distinct_counts_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(40)] + [7] * 20), rnd.random() < 0.4,
             rnd.choice(["x", "y", None]), rnd.choice([None, 1, 2, 3]), rnd.choice(["l1", "l2"]))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, id int, p boolean, c string, v int, l string").repartition(5)
    got = {r["k"]: r for r in aggregates.distinct_counts(
        df, ["k"], "id", {"vrai": F.col("p")}, {"m": F.col("v")}, {"codes": F.col("c")}, {"lot": F.col("l")}, total="n"
    ).collect()}
    for k in ("a", "b", None):
        mine = [r for r in rows if r[0] == k]
        ids = {r[1] for r in mine if r[1] is not None}
        vs = [r[4] for r in mine if r[4] is not None]
        assert got[k]["n"] == len(ids)
        assert got[k]["vrai"] == len({r[1] for r in mine if r[2] and r[1] is not None})
        assert got[k]["codes"] == len({r[3] for r in mine if r[3] is not None})
        assert (got[k]["m_somme"], got[k]["m_nombre"]) == (sum(vs), len(vs))
        assert got[k]["lot"] == max(r[5] for r in mine)


def _offers(spark, seed, rows=400):
    rnd = random.Random(seed)
    family, contract = list(marts.FAMILY_MEASURES.values()), list(marts.CONTRACT_MEASURES.values())
    data = [(rnd.choice([None, "hot"] + ["hot"] * 3 + [f"i{k}" for k in range(60)]), rnd.choice(family),
             rnd.choice(contract), rnd.choice(["75", "69", None]), rnd.random() < 0.5, rnd.random() < 0.3,
             Decimal(rnd.randint(1, 9)), rnd.choice(["f1", "f2"]), rnd.randint(0, 9)) for _ in range(rows)]
    df = spark.createDataFrame(
        data, "id_offre string, famille_metier_data string, categorie_contrat string, code_departement string, "
              "salaire_renseigne boolean, salaire_exploitable boolean, salaire_annuel_central decimal(12,2), "
              "fichier_source_silver string, anciennete_offre_jours int")
    fixed = {"code_departement_mart": F.coalesce("code_departement", F.lit("NR")), "nom_departement_mart": F.lit("d"),
             "code_region_mart": F.coalesce("code_departement", F.lit("NR")), "nom_region_mart": F.lit("r"),
             "delai_actualisation_jours": F.lit(1), "score_qualite_offre": F.lit(2), "batch_id": F.lit("b"),
             "date_chargement": F.current_timestamp(), "salaire_suspect": F.lit(False),
             "categorie_qualite_offre": F.lit("x"), "mention_cloud_devops": F.lit(True),
             "offre_difficile_a_pourvoir": F.lit(False), "information_entreprise_disponible": F.lit(None).cast("boolean"),
             "coordonnees_renseignees": F.lit(True), "est_offre_recente_30j": F.lit(True)}
    return data, df.withColumns(fixed).repartition(6)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_marts_follow_from_the_combined_rows(spark, seed, tmp_path):
    """An id that holds a third of the rows, in several categories, counts once per group and once in the total."""
    data, df = _offers(spark, seed)
    combined = marts.store(marts.combine(df), str(tmp_path))
    ids = {r[0] for r in data if r[0]}
    kpi = marts.market_kpis(combined).first()
    assert kpi["nombre_total_offres"] == len(ids) and kpi["nombre_departements_couverts"] == 2
    assert kpi["nombre_offres_salaire_renseigne"] == len({r[0] for r in data if r[4] and r[0]})
    for row in marts.by_family(combined).collect():
        mine = [r for r in data if r[1] == row["famille_metier_data"]]
        assert row["nombre_offres"] == len({r[0] for r in mine if r[0]})
        assert row["nombre_offres_cdi"] == len({r[0] for r in mine if r[0] and r[2] == "CDI"})
        assert row["part_offres_pct"] == round(Decimal(100) * row["nombre_offres"] / len(ids), 2)
        assert float(row["anciennete_moyenne_offres_jours"]) == round(float(np.mean([r[8] for r in mine])) + 1e-9, 2)
        assert row["fichier_source_silver"] == max(r[7] for r in mine)
    plain = {r["code_modalite"]: r for r in marts.salary_analysis(df).collect() if r["ordre_axe"] < 4}
    stored = {r["code_modalite"]: r for r in marts.salary_analysis(df, combined=combined).collect() if r["ordre_axe"] < 4}
    for code, row in stored.items():
        mine = [r for r in data if code in ("GLOBAL", r[1], r[2])]
        pay = [float(r[6]) for r in mine if r[5]]
        assert row["nombre_offres"] == len({r[0] for r in mine if r[0]}) == plain[code]["nombre_offres"]
        assert row["nombre_salaires_exploitables"] == len({r[0] for r in mine if r[0] and r[5]})
        assert float(row["salaire_annuel_median"]) == round(float(np.quantile(pay, 0.5)), 2)
        assert (row["salaire_annuel_min_observe"], row["salaire_annuel_max_observe"]) == (min(pay), max(pay))


def test_more_conditions_than_one_mask_holds(spark):
    data, df = _offers(spark, 5)
    measures = [marts.Measure(f"m{k}", F.col("salaire_annuel_central") + F.col("anciennete_offre_jours") == k % 20) for k in range(130)]
    combined = marts.combine(df, measures)
    assert [c for c in combined.states.columns if c.startswith("_mask")] == ["_mask0", "_mask1", "_mask2"]
    got = marts._counts(combined, {"k": F.col("famille_metier_data")}, [m.name for m in measures], "n").collect()
    assert got
    for row in got:
        for k in range(130):
            want = {r[0] for r in data if r[1] == row["k"] and r[0] is not None and int(r[6]) + r[8] == k % 20}
            assert row[f"m{k}"] == len(want)


def test_stored_rows_need_no_further_id_shuffle(spark, tmp_path):
    combined = marts.store(marts.combine(_offers(spark, 3)[1]), str(tmp_path))
    for build in (marts.market_kpis, marts.by_family, marts.by_contract, marts.by_area, marts.by_region):
        plan = build(combined)._jdf.queryExecution().executedPlan().toString()
        exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not any("_id#" in line or "id_offre#" in line for line in exchanged), exchanged
        assert "REPARTITION_BY_COL" not in plan


def test_counts_beyond_an_int(spark):
    """Three billion ids: the shares and the columns of a mart keep them."""
    counted = spark.range(1).select(F.lit(3_000_000_000).alias("nombre_offres"), F.lit(2_500_000_000).alias("n"))
    row = counted.select(*marts._with_shares([marts.Measure("n", F.lit(True), "part")], "nombre_offres")).first()
    assert row["n"] == 2_500_000_000 and row["part"] == Decimal("83.33")
    for name in ("market_kpis", "by_family", "salary_analysis"):
        schema = dict(getattr(marts, name)(_offers(spark, 1, 20)[1]).dtypes)
        assert not [c for c, kind in schema.items() if c.startswith("nombre_") and kind != "bigint"]


def test_quantiles_need_no_bucket_width(spark):
    """One key with nearly all rows, values over nine orders of magnitude and most of them close together."""
    rnd = np.random.RandomState(1)
    values = np.concatenate([rnd.randint(0, 3000, 6000), (10 ** rnd.uniform(0, 9, 3000)).astype(int)])
    rows = [("hot" if i % 50 else f"k{i % 3}", int(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    got = {r["k"]: r for r in aggregates.exact_quantiles(df, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.999}).collect()}
    for k, row in got.items():
        mine = [v for key, v in rows if key == k]
        assert [row[n] for n in "abc"] == pytest.approx([np.quantile(mine, q) for q in (0.25, 0.5, 0.999)], rel=1e-9)


@pytest.mark.parametrize("limit", [1, 30, 700])
def test_quantiles_rank_no_more_than_the_limit(spark, monkeypatch, limit):
    """Long stretches are cut again and again; equal values are one value, and ranks stay exact."""
    rnd = np.random.RandomState(2)
    values = np.concatenate([rnd.randint(0, 40, 4000), rnd.randint(0, 10 ** 12, 9000), [10 ** 12] * 3000])
    rows = [(None if i % 7 == 0 else "hot" if i % 5 else f"k{i % 30}", int(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    seen, real = [], aggregates._refined

    def refined(*args):
        live = real(*args)
        seen.append(live.groupBy("k", "_start").count().agg(F.max("count"), F.count("*")).first())
        return live

    monkeypatch.setattr(aggregates, "_refined", refined)
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.97, "e": 1.0}
    got = {r["k"]: r for r in aggregates.exact_quantiles(df, ["k"], "v", qs, limit=limit).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, row in got.items():
        mine = [v for key, v in rows if key == k]
        assert [row[n] for n in qs] == pytest.approx([np.quantile(mine, q) for q in qs.values()], rel=1e-9)
    assert seen[0][0] <= limit and seen[0][1] <= 2 * len(qs) * len(got)


def test_quantiles_of_values_no_double_tells_apart(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), (F.lit(1 << 60) + F.col("id") % 100).alias("v"))
    row = aggregates.exact_quantiles(df, ["k"], "v", {"low": 0.0, "high": 1.0}, limit=10).first()
    assert (row["low"], row["high"]) == (float(1 << 60), float((1 << 60) + 99))
    assert aggregates.exact_quantiles(df.limit(0), ["k"], "v", {"m": 0.5}).count() == 0


def test_more_conditions_than_one_mask_holds(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 2).alias("k"))
    got = aggregates.distinct_counts(df, ["k"], "id", {f"c{i}": F.col("id") < i for i in range(150)}, total="n")
    assert {r["k"]: (r["n"], r["c149"], r["c62"], r["c3"]) for r in got.collect()} == {0: (100, 75, 31, 2), 1: (100, 74, 31, 1)}


def test_market_kpis_of_no_offers_is_one_row(spark):
    schema = ("id_offre string, famille_metier_data string, categorie_contrat string, salaire_renseigne boolean, "
              "mention_cloud_devops boolean, offre_difficile_a_pourvoir boolean, "
              "information_entreprise_disponible boolean, coordonnees_renseignees boolean, "
              "est_offre_recente_30j boolean, categorie_qualite_offre string, code_departement string, "
              "anciennete_offre_jours int, delai_actualisation_jours int, score_qualite_offre int, batch_id string, "
              "fichier_source_silver string, date_chargement timestamp")
    row = marts.market_kpis(spark.createDataFrame([], schema)).collect()
    assert len(row) == 1
    assert row[0]["nombre_total_offres"] == 0 and row[0]["part_cdi_pct"] is None
    assert row[0]["nombre_departements_couverts"] == 0 and row[0]["score_moyen_qualite_offre"] is None


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bucket", [0.5, 10.0, 1e6])
def test_exact_quantiles_match_numpy(spark, seed, bucket):
    rnd = random.Random(seed)
    # One value holds a third of all rows, one group most of the rest.
    rows = [(rnd.choice(["hot"] * 8 + ["b", None]), rnd.choice([50.0, rnd.uniform(-20, 120), rnd.gauss(50, 2)]),
             rnd.random() < 0.9) for _ in range(900)]
    rows += [("single", 5.0, True), ("none", 1.0, False)]
    df = spark.createDataFrame(rows, "k string, v double, ok boolean").repartition(7)
    qs = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    got = {r["k"]: r for r in aggregates.exact_quantiles(df, ["k"], "v", qs, F.col("ok"), bucket).collect()}
    assert set(got) == {"hot", "b", None, "single"}
    for k, row in got.items():
        v = [r[1] for r in rows if r[0] == k and r[2]]
        assert [row[n] for n in qs] == pytest.approx([np.quantile(v, q) for q in qs.values()], abs=1e-9)


def test_exact_quantiles_on_decimals_and_without_keys(spark):
    df = spark.createDataFrame([(Decimal("1.01"),), (Decimal("2.02"),), (Decimal("3.04"),), (None,)], "v decimal(12,2)")
    row = aggregates.exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.25}).first()
    assert (float(row["m"]), float(row["q"])) == (2.02, 1.515)


HITS = [("q1", 0, "A", "a1"), ("q1", 1, "A", "a2"), ("q1", 2, None, "x"), ("q2", 0, "B", "b1"), ("q2", 1, "A", "a3"),
        ("q2", 2, "", "y"), ("q3", 0, "B", "b2"), ("q3", 1, "B", "b3"), ("q3", 2, "C", "c1")]
QUERIES = ["q1", "q2", "q3", "q4"]


def test_merge_first_hit_wins_and_keeps_all_queries(spark):
    df = spark.createDataFrame(HITS, "query string, pos int, id string, payload string").repartition(4)
    got = {r["id"]: (r["payload"], r["search_keyword"], r["search_keywords"])
           for r in merge.merge_hits(df, QUERIES, "id", "query", ["pos"]).collect()}
    assert got == {"A": ("a1", "q1", ["q1", "q2"]), "B": ("b1", "q2", ["q2", "q3"]), "C": ("c1", "q3", ["q3"])}


def test_funnel_lists_queries_without_hits(spark):
    df = spark.createDataFrame(HITS, "query string, pos int, id string, payload string")
    got = [tuple(r) for r in merge.funnel(df, QUERIES, "id", "query").orderBy("ordre").collect()]
    # ordre, requete, results, new, known, doubles, no id, covered, exclusive
    assert got == [(1, "q1", 3, 1, 0, 1, 1, 1, 0), (2, "q2", 3, 1, 1, 0, 1, 2, 0), (3, "q3", 3, 1, 1, 1, 0, 2, 1),
                   (4, "q4", 0, 0, 0, 0, 0, 0, 0)]
    merged = merge.merge_hits(df, QUERIES, "id", "query", ["pos"])
    assert [tuple(r) for r in merge.coverage(merged, QUERIES).collect()] == [
        ("q1", 1, 0), ("q2", 2, 0), ("q3", 2, 1), ("q4", 0, 0)]


def test_hits_of_other_queries_are_counted_last(spark):
    df = spark.createDataFrame(HITS, "query string, pos int, id string, payload string")
    got = [tuple(r) for r in merge.funnel(df, ["q1", "q4"], "id", "query").orderBy("ordre").collect()]
    # q2 and q3 return A once, B three times, C once and one row without id.
    assert got == [(1, "q1", 3, 1, 0, 1, 1, 1, 0), (2, "q4", 0, 0, 0, 0, 0, 0, 0), (3, None, 6, 2, 1, 2, 1, 3, 2)]
    merged = merge.merge_hits(df, ["q1", "q4"], "id", "query", ["pos"])
    assert [tuple(r) for r in merge.coverage(merged, ["q1", "q4"]).collect()] == [("q1", 1, 0), ("q4", 0, 0), (None, 3, 2)]
    none = df.withColumn("query", F.lit(None).cast("string"))
    assert sum(r.resultats_api for r in merge.funnel(none, ["q1"], "id", "query").collect()) == len(HITS)
    merged = merge.merge_hits(none, ["q1"], "id", "query", ["pos"])
    assert [tuple(r) for r in merge.coverage(merged, ["q1"]).collect()] == [("q1", 0, 0), (None, 3, 3)]


def test_ranks_break_ties_and_put_the_unknown_area_last(spark):
    rows = [(str(i), code) for i, code in enumerate(["NR"] * 5 + ["84"] * 2 + ["11"] * 2 + ["93"] * 3)]
    base = spark.createDataFrame(rows, "id_offre string, code_region_mart string")
    null = {c: F.lit(None).cast(t) for c, t in {
        "nom_region_mart": "string", "famille_metier_data": "string", "categorie_contrat": "string",
        "salaire_renseigne": "boolean", "mention_cloud_devops": "boolean", "offre_difficile_a_pourvoir": "boolean",
        "information_entreprise_disponible": "boolean", "coordonnees_renseignees": "boolean",
        "est_offre_recente_30j": "boolean", "categorie_qualite_offre": "string", "code_departement": "string",
        "anciennete_offre_jours": "int", "delai_actualisation_jours": "int", "score_qualite_offre": "int",
        "batch_id": "string", "fichier_source_silver": "string", "date_chargement": "timestamp"}.items()}
    got = marts.by_region(base.withColumns(null), datetime(2024, 1, 1)).collect()
    assert [(r.rang_region, r.code_region, r.nombre_offres, r.part_offres_pct) for r in got] == [
        (1, "93", 3, Decimal("25.00")), (2, "11", 2, Decimal("16.67")), (3, "84", 2, Decimal("16.67")),
        (4, "NR", 5, Decimal("41.67"))]
    assert got[0].nombre_offres_salaire_non_renseigne == 3


def test_reference_is_complete_and_checked(spark):
    reference = dimension.build_reference(*dimension.preset_areas(spark))
    rows = reference.collect()
    assert sorted(dimension.preset_reference(spark).collect()) == sorted(rows)
    assert len(rows) == 101 and len({r.code_region for r in rows}) == 18
    assert [r.code_departement for r in rows] == sorted(r.code_departement for r in rows)
    assert {r.code_departement: r.nom_region for r in rows}["2A"] == "Corse"
    assert set(long(dimension.reference_problems(reference)).values()) == {0}
    areas, regions = dimension.preset_areas(spark)
    with pytest.raises(PySparkException, match="more than once"):
        dimension.build_reference(areas, regions.unionByName(regions)).collect()


def test_generic_tests_count_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k int, s string")
    got = long(checks.generic_tests(df, ["k", "s"], ["k"], {"s": ["a", "b"]}))
    assert got == {"not_null_k": 1, "not_null_s": 1, "accepted_values_s": 1, "unique_k": 1}
    with pytest.raises(checks.ContractError, match="unique_k=1"):
        checks.assert_none(checks.generic_tests(df, [], ["k"]))


def test_single_value_check(spark):
    df = spark.createDataFrame([("a", None, "x"), ("a", "b", "y")], "one string, gap string, two string")
    rules = {"one": checks.not_single("one", "a"), "other": checks.not_single("one", "b"),
             "gap": checks.not_single("gap"), "two": checks.not_single("two")}
    assert long(checks.long_form(df, rules)) == {"one": 0, "other": 1, "gap": 1, "two": 1}
    assert long(checks.long_form(df.limit(0), rules)) == {"one": 1, "other": 1, "gap": 1, "two": 1}


RECORD = ('{"id":"%s","intitule":" Data Engineer ","lieuTravail":{"libelle":"75 - Paris","pays":"FR"},'
          '"entreprise":null,"competences":[{"code":1}],"search_keyword":"BI analyst",'
          '"search_keywords":["BI analyst"],"ingestion_timestamp":"2024-01-01_00-00-00",'
          '"dateCreation":"2024-01-01T00:00:00Z","autre":{"x":[1]},"alternance":true,"nombrePostes":2}')


def raw(spark, *ids):
    return bronze.parse(spark.createDataFrame([(RECORD % i,) for i in ids], "record string"))


def test_flatten_has_a_stable_schema_and_loses_nothing(spark):
    parsed = raw(spark, "1")
    row = bronze.flatten(parsed, extra=["autre"]).first().asDict()
    assert row["lieuTravail_libelle"] == "75 - Paris" and row["entreprise_nom"] is None
    assert row["competences"] == '[{"code":1}]' and row["autre"] == '{"x":[1]}' and row["permis"] is None
    assert row["alternance"] is True and row["nombrePostes"] == 2 and '"pays":"FR"' in row["raw_record"]
    drift = [tuple(r) for r in bronze.schema_drift(parsed).collect()]
    assert drift == [("lieuTravail", "pays", False, 1)]


def test_type_change_of_a_nested_field_blocks(spark):
    parsed = bronze.parse(spark.createDataFrame([('{"salaire":"x"}',), ('{"salaire":null}',), ('{"salaire":[1]}',)], "record string"))
    assert [tuple(r) for r in bronze.schema_drift(parsed).collect()] == [("salaire", None, True, 2)]


def test_raw_gate_counts_each_defect(spark):
    records = [RECORD % "1", RECORD % "1", RECORD % "", "[1]", '{"id":"2"}',
               '{"id":"3","search_keyword":"a","search_keywords":"a"}',
               '{"id":"4","search_keyword":"a","search_keywords":[]}',
               '{"id":"5","search_keyword":"a","search_keywords":["b"],"ingestion_timestamp":"2024-01-01_00-00-00"}',
               '{"id":"6","search_keyword":"a","search_keywords":["a"]}']
    df = bronze.parse(spark.createDataFrame([(r,) for r in records], "record string"))
    got = long(bronze.record_checks(df, ["a", "BI analyst"]))
    assert got == {"lot_vide": 0, "entrees_non_objet": 1, "sans_id": 1, "ids_dupliques": 1, "sans_mot_cle": 1,
                   "sans_liste_mots_cles": 1, "mots_cles_non_liste": 1, "mots_cles_vides": 1, "mot_cle_hors_liste": 1,
                   "sans_instant": 1, "instants_multiples": 0, "mots_cles_inconnus": 1}


def silver(spark, *ids):
    flat = bronze.with_lineage(bronze.flatten(raw(spark, *ids)), "b", "r", "f", "k")
    return cleaning.to_silver(flat, "r2", "key")


def test_silver_layer(spark):
    df = silver(spark, "1")
    row = df.first()
    assert (row.intitule_offre, row.mot_cle_recherche, row.est_alternance) == ("Data Engineer", "bi analyst", True)
    assert (row.localisation_renseignee, row.coordonnees_renseignees, row.salaire_renseigne) == (True, False, False)
    assert row.date_actualisation_coherente is None and "entreprise_entrepriseAdaptee" not in df.columns
    assert set(long(gates.silver_indicators(df)).values()) == {0}
    assert set(long(gates.keyword_checks(df)).values()) == {0}
    assert set(long(gates.technical_dates(df)).values()) == {0}
    bad = df.withColumn("localisation_renseignee", F.lit(False)).withColumn("mots_cles_recherche", F.lit('["x"]'))
    assert long(gates.silver_indicators(bad))["localisation_renseignee_incoherent"] == 1
    assert long(gates.keyword_checks(bad))["mot_cle_hors_liste"] == 1


def test_missing_bronze_column_is_named(spark):
    with pytest.raises(checks.ContractError, match="romeCode"):
        cleaning.to_silver(bronze.flatten(raw(spark, "1")).drop("romeCode"), "r", "k")


def test_bronze_gate_reports_repeated_ids_once(spark):
    parsed = raw(spark, "1", "2", "2")
    pairs = parsed.select(bronze.field("id").alias("id"), "record")
    got = long(gates.bronze_equals_raw(pairs, bronze.flatten(parsed)))
    assert got.pop("ids_dupliques") == 1 and set(got.values()) == {0}


def test_row_comparison_sees_nulls_and_nested_values(spark):
    schema = "id int, a string, b string, t timestamp, l array<int>"
    day = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, "x", None, day, [1]), (2, None, "x", day, [1]), (3, "a", "b", None, [1]),
                                  (4, "a", "b", day, [1, 2]), (5, "a", "b", day, None)], schema)
    right = spark.createDataFrame([(1, "x", None, day, [1]), (2, "x", None, day, [1]), (4, "a", "b", day, [2, 1]),
                                   (5, "a", "b", day, None), (6, "a", "b", day, None)], schema)
    got = {r["id"]: r["statut"] for r in identity.compare_rows(left, right, "id").collect()}
    assert got == {"1": "identique", "2": "different", "3": "absent", "4": "different", "5": "identique", "6": "en_trop"}
    summary = identity.comparison_summary(identity.compare_rows(left, right, "id")).first()
    assert summary.exemples_differents == "2,4" and summary.contenu_identique is False


def test_nan_equals_null_in_a_row_comparison(spark):
    a = spark.createDataFrame([(1, float("nan"))], "id int, v double")
    b = spark.createDataFrame([(1, None)], "id int, v double")
    assert identity.compare_rows(a, b, "id").first()["statut"] == "identique"


def test_schema_comparison(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1).withColumn("y", F.lit(1))
    got = identity.compare_schemas(a, b, ["z"])
    assert got["colonnes_absentes"] == ["x"] and got["colonnes_inattendues"] == ["y"]
    assert got["colonnes_techniques_absentes"] == ["z"] and not got["schema_valide"]


def test_profiles_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert {r["completeness_rate"] for r in profiles.completeness(df).collect()} == {None}
    assert {r["taux_manquant"] for r in profiles.missing_ranking(df).collect()} == {0.0}


def test_missing_counts_blank_text_and_empty_lists(spark):
    df = spark.createDataFrame([(" ", [], float("nan")), (None, None, 1.0), ("x", [1], None)],
                               "s string, l array<int>, d double")
    assert {r["colonne"]: r["missing_count"] for r in profiles.completeness(df).collect()} == {"s": 2, "l": 2, "d": 2}


def test_flatten_walks_a_record_once(spark):
    """One read of the whole record gives what a path of its own gives for every column, odd values included."""
    rows = [
        '{"id":5,"alternance":"true","nombrePostes":"3","lieuTravail":{"libelle":{"a":[1]},"latitude":"1.5"},"x y":1,"a.b":[2]}',
        '{"id":1.50,"alternance":1,"nombrePostes":2.7,"lieuTravail":"Paris","salaire":[1],"entreprise":null,"ID":"big"}',
        '{"id":{"b":1,"a":"\\u00e9"},"nombrePostes":99999999999999999999,"lieuTravail":{"LIBELLE":"up"}}', "[1]", "null", "oops", None]
    parsed = bronze.parse(spark.createDataFrame([(r,) for r in rows], "record string").repartition(1))
    flat = bronze.flatten(parsed, extra=("x y", "a.b"))
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("variant_get(") == 1
    names = {"lieuTravail_libelle": ("lieuTravail", "libelle"), "salaire_libelle": ("salaire", "libelle"), "id": ("id",), "a.b": ("a.b",),
             "x y": ("x y",), "entreprise_nom": ("entreprise", "nom")}
    kinds = {"alternance": "boolean", "nombrePostes": "bigint"}
    by_path = parsed.select(*(bronze.field(*keys).alias(n) for n, keys in names.items()),
                            *(bronze.field(n, kind=k).alias(n) for n, k in kinds.items()))
    assert flat.select(*(f"`{n}`" for n in [*names, *kinds])).collect() == by_path.collect()
    assert "Zeta" in bronze.flatten(parsed, extra=("zeta", "Zeta")).columns  # names that differ by case alone are read by path


def test_keys_come_from_the_first_level(spark):
    parsed = bronze.parse(spark.createDataFrame([('{"a":{"b":1},"c":null}',), ('{"a":2}',), ("[1]",), ("null",), (None,)], "record string"))
    found = bronze.top_level_keys(parsed)
    assert sorted(map(tuple, found.collect())) == [("a", 2), ("c", 1)]
    assert "to_json" not in found._jdf.queryExecution().optimizedPlan().toString()
