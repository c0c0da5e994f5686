"""Literal cases of every rule."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tamis.functions import dates, flags, json, place, rates, salary, text
from tamis.operators import enrichment, salaries
from tamis.presets import rules


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_clean_keeps_case_and_strips_all_white_space(spark):
    rows = [("\t Data  BI \n",), ("  x　\x1f",), ("  ",), (None,), ("",)]
    assert values(spark, rows, "s string", text.clean(F.col("s"))) == ["Data  BI", "x", None, None, None]


def test_joined_keeps_the_space_of_a_null(spark):
    assert values(spark, [("a", None, "b")], "x string, y string, z string",
                  text.joined(F.col("x"), F.col("y"), F.col("z"))) == ["a  b"]


@pytest.mark.parametrize("word,expected", [
    ("équipe bi, paris", "Data Analysis / BI"), ("ébi", "Autre data / numérique"), ("bi", "Data Analysis / BI"),
    ("abi bi2 b i", "Autre data / numérique"), ("l'ia et", "Data Science / IA"), ("ia", "Data Science / IA"),
    ("expert ia", "Data Science / IA"), ("media_ia_x", "Data Science / IA"), ("médiaia", "Autre data / numérique"),
    ("data engineer et data analyst", "Data Engineering"), ("data analyst machine learning", "Data Analysis / BI"),
    ("rien", "Autre data / numérique"), ("bibi bi", "Data Analysis / BI"),
])
def test_family(spark, word, expected):
    df = spark.createDataFrame([(word,)], "texte_analyse_offre string")
    assert enrichment.with_family(df).first()["famille_metier_data"] == expected


def test_technologies_keep_their_order_and_appear_once(spark):
    rows = [("cicd et ci/cd, docker, aws",), ("rien",), ("cloud devops kubernetes terraform gcp azure",)]
    df = enrichment.with_technologies(spark.createDataFrame(rows, "texte_analyse_offre string"))
    got = [(r["technologies_cloud_devops_detectees"], r["mention_cloud_devops"]) for r in df.collect()]
    assert got == [("AWS, Docker, CI/CD", True), (None, False),
                   ("Azure, GCP, Cloud, DevOps, Kubernetes, Terraform", True)]


@pytest.mark.parametrize("commune,postcode,label,expected", [
    ("2A004", None, None, "2A"), ("2b033", None, None, "2B"), ("97105", None, None, "971"),
    ("97611", None, None, "976"), ("75056", None, None, "75"), ("9705", None, None, None),
    (None, "97400", None, "974"), (None, "75001", None, "75"), (None, "99999", None, None),
    (None, "98800", None, None), (None, "20000", None, "20"), (None, None, "2A - Ajaccio", "2A"),
    (None, None, "974 - Saint-Denis", "974"), (None, None, "976-Mamoudzou", "976"), (None, None, "69 - Lyon", "69"),
    (None, None, "France", None), (None, None, None, None), ("99999", "33000", "69 - Lyon", "33"),
    (" 13055 ", "33000", None, "13"), ("975", None, "96 - x", None), ("00123", "01000", None, "01"),
])
def test_area_code(spark, commune, postcode, label, expected):
    expression = place.area_code(F.col("c"), F.col("p"), F.col("l"))
    assert values(spark, [(commune, postcode, label)], "c string, p string, l string", expression) == [expected]


@pytest.mark.parametrize("flag,code,expected", [
    (True, "CDI", "Alternance"), (False, "CDI-I", "CDI"), (None, "MIS", "CDD / mission"), (None, "SAI", "CDD / mission"),
    (False, "PRO", "Alternance"), (False, "FRA", "Indépendant / franchise"), (False, None, "Non renseigné"),
    (None, "XYZ", "Autre"),
])
def test_contract(spark, flag, code, expected):
    df = spark.createDataFrame([(flag, code)], "est_alternance boolean, code_type_contrat string")
    assert enrichment.with_contract(df).first()["categorie_contrat"] == expected


@pytest.mark.parametrize("label,expected", [
    (None, "Non renseigné"), ("Débutant accepté", "Débutant accepté"), ("DEBUTANT", "Débutant accepté"),
    ("2 An(s)", "Expérience demandée"), ("sans", "Expérience demandée"), ("Exigé", "Autre"),
])
def test_experience(spark, label, expected):
    df = spark.createDataFrame([(label,)], "libelle_experience string")
    assert enrichment.with_experience(df).first()["categorie_experience"] == expected


@pytest.mark.parametrize("a,b,expected", [
    ("35H Temps Plein", None, "Temps plein"), (None, "temps partiel", "Temps partiel"),
    ("temps partiel", "temps plein", "Temps plein"), (None, None, "Non renseigné"), ("24H", None, "Autre"),
])
def test_working_time(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "libelle_duree_travail string, libelle_duree_travail_converti string")
    assert enrichment.with_working_time(df).first()["categorie_temps_travail"] == expected


def test_dates(spark):
    ref = datetime(2024, 7, 31, 12)
    rows = [(datetime(2024, 8, 5), None, ref), (datetime(2024, 7, 1, 23), datetime(2024, 7, 4, 1), ref),
            (datetime(2024, 6, 30), datetime(2024, 6, 1), ref), (None, ref, ref)]
    df = spark.createDataFrame(
        rows, "date_creation timestamp, date_actualisation timestamp, date_ingestion timestamp"
    ).withColumn("date_chargement", F.lit(None).cast("timestamp"))
    got = [(r.anciennete_offre_jours, r.delai_actualisation_jours, r.est_offre_recente_30j)
           for r in enrichment.with_dates(df).collect()]
    assert got == [(0, None, True), (30, 3, True), (31, 0, False), (None, None, False)]


def test_tolerant_timestamps(spark):
    rows = [("2024-07-14T10:00:00Z", "2024-07-14_10-00-00"), ("hier", "2024-07-14"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(dates.to_instant(F.col("a")).cast("string"),
                    dates.to_instant(F.col("b"), dates.INGESTION_FORMAT).cast("string")).collect()
    assert [tuple(r) for r in got] == [("2024-07-14 10:00:00", "2024-07-14 10:00:00"), (None, None), (None, None)]


def test_booleans(spark):
    rows = [("true",), (" OUI ",), ("0",), ("non",), (None,)]
    assert values(spark, rows, "s string", flags.to_boolean(F.col("s"))) == [True, True, False, False, None]
    with pytest.raises(PySparkException, match="not a boolean"):
        values(spark, [("maybe",)], "s string", flags.to_boolean(F.col("s")))


def test_shares(spark):
    rows = [(1, 3), (1, 0), (None, 4), (889, 889), (2, 3)]
    got = values(spark, rows, "n long, d long", rates.share(F.col("n"), F.col("d")))
    assert got == [Decimal("33.33"), None, None, Decimal("100.00"), Decimal("66.67")]


def test_report_rate_rounds_like_python(spark):
    rows = [(n, d) for d in (7, 8, 400, 800, 1600) for n in range(0, d + 1, max(1, d // 97))]
    got = values(spark, rows, "n long, d long", rates.report_rate(F.col("n"), F.col("d")))
    assert got == [round((n / d) * 100, 2) for n, d in rows]


def test_json_validity_needs_one_whole_value(spark):
    good = ['{"a": [1, 2]}', "[]", "1", '"x"', "null", " {} ", '["]"]']
    bad = ['"k": 69}', "{} {}", "1 2", "[1],[2]", "1],[2", '1}{"a":2', '1,"b":2', "{oops", "", "[1]]", "{}}", "1,2"]
    got = values(spark, [(s,) for s in good + bad], "s string", json.is_valid(F.col("s")))
    assert got == [True] * len(good) + [False] * len(bad)


LABELS = [
    # label, period kept before -> parsed, min, max, annual max, suspect, usable, reason
    ("Annuel de 40000.0 Euros à 45000.0 Euros", "Annuel", True, 40000, 45000, 45000, False, True, None),
    ("Annuel de 40000 Euros sur 12 mois", "Annuel", True, 40000, 40000, 40000, False, True, None),
    ("Mensuel de 2000 Euros", "Mensuel", True, 2000, 2000, 24000, False, True, None),
    ("Mensuel de 45000 Euros", "Mensuel", True, 45000, 45000, 540000, True, False, "suspect"),
    ("Horaire de 12.5 Euros à 15 Euros", "Horaire", True, 12.5, 15, None, False, False, "hourly"),
    ("Annuel de 30000 Euros - Selon profil", "Annuel", True, 30000, 30000, 30000, False, True, None),
    ("Annuel de 30000 Euros - Selon\nprofil", "Annuel", True, 30000, 30000, 30000, False, True, None),
    ("annuel de 30000 Euros", "Annuel", False, None, None, None, False, False, "unparsed"),
    ("Annuel de 40 000 Euros", "Annuel", False, None, None, None, False, False, "unparsed"),
    ("Annuel de 0 Euros", "Annuel", True, 0, 0, 0, False, False, "not_positive"),
    ("Annuel de 50000 Euros à 40000 Euros", "Annuel", True, 50000, 40000, 40000, False, False, "reversed"),
    ("Annuel de 200000 Euros", "Annuel", True, 200000, 200000, 200000, False, True, None),
    ("Annuel de 200000.01 Euros", "Annuel", True, 200000.01, 200000.01, 200000.01, True, False, "suspect"),
    ("Annuel de 30000 Euros", "Mensuel", True, 30000, 30000, 30000, False, False, "incoherent"),
    ("Annuel de 30000 Euros\n", "Annuel", False, None, None, None, False, False, "unparsed"),
    (" Annuel de 30000. Euros ", "Annuel", True, 30000, 30000, 30000, False, True, None),
]


def test_salary_labels(spark):
    df = spark.createDataFrame(
        [(i, r[0], r[1], True) for i, r in enumerate(LABELS)],
        "id int, salaire_libelle string, periode_salaire_normalisee string, salaire_renseigne boolean")
    got = salaries.normalise(df).orderBy("id").collect()
    number = lambda v: None if v is None else float(v)
    for row, (label, _, parsed, low, high, annual, suspect, usable, reason) in zip(got, LABELS, strict=True):
        assert (row.salaire_parse_ok, number(row.salaire_min_brut), number(row.salaire_max_brut),
                number(row.salaire_annuel_max), row.salaire_suspect, row.salaire_exploitable,
                row.motif_non_exploitation) == (
            parsed, low, high, annual, suspect, usable, rules.REASONS.get(reason)), label
    assert got[0].format_salaire == rules.AMOUNT_RANGE and got[1].format_salaire == rules.SINGLE_AMOUNT
    assert number(got[1].duree_mois_brute) == 12 and number(got[0].salaire_annuel_central) == 42500


def test_unstated_salaries_have_no_row_but_keep_their_facts_false(spark):
    df = spark.createDataFrame(
        [("a", None, None, False), ("b", "Annuel de 1 Euros", "Annuel", None)],
        "id_offre string, salaire_libelle string, periode_salaire_normalisee string, salaire_renseigne boolean")
    assert salaries.normalise(df).count() == 0
    facts = salaries.attach_facts(df).collect()
    assert [(r.salaire_parse_ok, r.salaire_exploitable, r.salaire_annuel_central) for r in facts] == [
        (False, False, None)] * 2


def test_period(spark):
    rows = [(" annuel x",), ("MENSUEL",), ("Horaire de",), ("De Annuel",), ("\nAnnuel",), (None,), ("",)]
    assert values(spark, rows, "s string", salary.period_of(F.col("s"))) == [
        "Annuel", "Mensuel", "Horaire", None, "Annuel", None, None]


def test_completeness_classes(spark):
    cols = ["id_offre", "intitule_offre", "description_offre", "code_type_contrat", "code_rome"]
    rows = [("1", "a", "b", "c", "d", True, True, None), ("1", "a", "b", "c", None, True, None, False),
            ("1", None, None, None, None, None, None, None)]
    schema = ", ".join(f"{c} string" for c in cols) + ", localisation_renseignee boolean, " \
        "information_entreprise_disponible boolean, salaire_renseigne boolean"
    got = [(r.score_qualite_offre, r.categorie_qualite_offre)
           for r in enrichment.with_completeness(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(7, "Offre très complète"), (5, "Offre moyennement complète"), (1, "Offre peu complète")]
