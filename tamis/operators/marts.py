"""KPI marts over enriched offers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.functions import flags, rates
from tamis.operators import aggregates
from tamis.presets import rules

MEANS = {
    "anciennete_moyenne_offres_jours": "anciennete_offre_jours",
    "delai_moyen_actualisation_jours": "delai_actualisation_jours",
    "score_moyen_qualite_offre": "score_qualite_offre",
}
LINEAGE = {
    "batch_id": "batch_id",
    "fichier_source_silver": "fichier_source_silver",
    "date_chargement_batch": "date_chargement",
}
COVERED = "nombre_departements_couverts"

# Name part of a measure -> category it counts.
FAMILY_MEASURES = {
    "data_engineering": "Data Engineering",
    "data_analysis_bi": "Data Analysis / BI",
    "data_science_ia": "Data Science / IA",
    "autre_data_numerique": "Autre data / numérique",
}
CONTRACT_MEASURES = {
    "cdi": "CDI",
    "cdd_mission": "CDD / mission",
    "alternance": "Alternance",
    "independant_franchise": "Indépendant / franchise",
}
CLASS_MEASURES = {
    "tres_completes": "Offre très complète",
    "moyennement_completes": "Offre moyennement complète",
    "peu_completes": "Offre peu complète",
}


@dataclass(frozen=True)
class Measure:
    """A conditional distinct count and, if wanted, the name of its share of the total."""

    name: str
    condition: Column
    share: str | None = None


def _equals(column: str, values: Mapping[str, str], suffix: str = "", unshared: Sequence[str] = ()) -> list[Measure]:
    return [
        Measure(
            f"nombre_offres_{part}",
            flags.is_true(F.col(column) == value),
            None if part in unshared else f"part_{part}{suffix}_pct",
        )
        for part, value in values.items()
    ]


def families(suffix: str = "", unshared: Sequence[str] = ()) -> list[Measure]:
    return _equals("famille_metier_data", FAMILY_MEASURES, suffix, unshared)


def contracts(suffix: str = "") -> list[Measure]:
    return _equals("categorie_contrat", CONTRACT_MEASURES, suffix)


def classes() -> list[Measure]:
    return [
        Measure(f"nombre_offres_{part}", flags.is_true(F.col("categorie_qualite_offre") == value),
                f"part_offres_{part}_pct")
        for part, value in CLASS_MEASURES.items()
    ]


def salary_stated() -> Measure:
    return Measure("nombre_offres_salaire_renseigne", flags.is_true(F.col("salaire_renseigne")),
                   "taux_transparence_salariale_pct")


def salary_missing(share: str | None = None) -> Measure:
    return Measure("nombre_offres_salaire_non_renseigne", flags.is_not_true(F.col("salaire_renseigne")), share)


def signals(cloud_share: str = "taux_mention_cloud_devops_pct",
            recent_share: str = "taux_offres_recentes_30j_pct") -> list[Measure]:
    table = (
        ("mention_cloud_devops", "mention_cloud_devops", cloud_share),
        ("difficiles_a_pourvoir", "offre_difficile_a_pourvoir", "taux_offres_difficiles_a_pourvoir_pct"),
        ("information_entreprise_disponible", "information_entreprise_disponible",
         "taux_information_entreprise_disponible_pct"),
        ("geolocalisees", "coordonnees_renseignees", "taux_offres_geolocalisees_pct"),
        ("recentes_30j", "est_offre_recente_30j", recent_share),
    )
    return [Measure(f"nombre_offres_{n}", flags.is_true(F.col(c)), s) for n, c, s in table]


def kpi_measures() -> list[Measure]:
    other = F.col("categorie_contrat").isin(rules.OTHER, rules.UNKNOWN)
    return [
        *families(),
        *contracts(),
        Measure("nombre_offres_autres_contrats", flags.is_true(other), "part_autres_contrats_pct"),
        salary_stated(),
        salary_missing("taux_salaire_non_renseigne_pct"),
        *signals("taux_offres_mention_cloud_devops_pct", "part_offres_recentes_30j_pct"),
        Measure("nombre_offres_non_signalees_difficiles",
                flags.is_not_true(F.col("offre_difficile_a_pourvoir"))),
        Measure("nombre_offres_information_entreprise_absente",
                flags.is_not_true(F.col("information_entreprise_disponible")),
                "taux_information_entreprise_absente_pct"),
        Measure("nombre_offres_non_geolocalisees", flags.is_not_true(F.col("coordonnees_renseignees")),
                "taux_offres_non_geolocalisees_pct"),
        *classes(),
    ]


@dataclass(frozen=True)
class Mart:
    """What distinguishes one grouped mart from another."""

    keys: Mapping[str, str]
    measures: Sequence[Measure]
    rank: str
    covers_areas: bool = True
    unknown: tuple[str, str] | None = None


CATEGORIES = ("famille_metier_data", "categorie_contrat", "code_departement", "code_departement_mart",
              "nom_departement_mart", "code_region_mart", "nom_region_mart")
PAY = "paie"


@dataclass(frozen=True)
class Combined:
    """What all marts read: one narrow row per id and category combination, and where the offers came from."""

    states: DataFrame
    origins: DataFrame
    conditions: tuple[str, ...]


def all_measures() -> list[Measure]:
    """Every measure of every mart once, in the order of the mask's bits."""
    marts = (kpi_measures(), *(m.measures for m in (_family(), _contract(), _area(), _region())))
    found = {m.name: m for measures in marts for m in measures}
    return [*found.values(), *salary_measures()]


def salary_measures() -> list[Measure]:
    stated, usable = flags.is_true(F.col("salaire_renseigne")), flags.is_true(F.col("salaire_exploitable"))
    return [
        Measure("nombre_salaires_renseignes", stated),
        Measure("nombre_salaires_suspects", flags.is_true(F.col("salaire_suspect"))),
        Measure("nombre_salaires_exploitables", usable),
        Measure("nombre_salaires_non_exploitables", stated & ~usable),
    ]


def _place(condition: int) -> tuple[str, int]:
    """Mask and bit of the condition of that number."""
    return f"_mask{condition // 62}", 1 << condition % 62


def combine(offers: DataFrame, measures: Sequence[Measure] | None = None, pay: bool = True, buckets: int = 0) -> Combined:
    """Rows per (id, categories) with a bit per condition (62 to a mask), sums for the means, and bounds of usable pay.

    Every mart follows from these rows: an id counts under a condition if any of its rows fulfils it. Offers of one id and
    combination shrink before the shuffle, and origins hold no ids at all. With ``buckets`` the narrow rows are dealt by id
    into as many partitions first, which ``store`` keeps: one shuffle for both, and ids are unique as a rule.
    """
    measures = all_measures() if measures is None else list(measures)
    keys = [c for c in CATEGORIES if c in offers.columns]
    masks = {f"_mask{i}": F.lit(0).cast("long") for i in range(max(1, -(-len(measures) // 62)))}
    for i, m in enumerate(measures):
        mask, bit = _place(i)
        masks[mask] = masks[mask].bitwiseOR(F.when(m.condition, F.lit(bit)).otherwise(F.lit(0)).cast("long"))
    values = {name: F.col(c) for name, c in MEANS.items()}
    if pay:
        values[PAY] = F.when(flags.is_true(F.col("salaire_exploitable")), F.col("salaire_annuel_central"))
    rows = offers.select("id_offre", *keys, *[c.alias(n) for n, c in masks.items()],
                         *[c.alias(n) for n, c in values.items()])
    rows = rows.repartition(buckets, "id_offre") if buckets else rows
    carried = [f(n).alias(f"{n}{s}") for n in values for s, f in (("_somme", F.sum), ("_nombre", F.count))]
    carried += [F.min(PAY).alias("paie_min"), F.max(PAY).alias("paie_max")] if pay else []
    states = rows.groupBy("id_offre", *keys).agg(*[F.bit_or(n).alias(n) for n in masks], *carried)
    origins = offers.select(*keys, *[F.col(c).alias(n) for n, c in LINEAGE.items()]).distinct()
    return Combined(states, origins, tuple(m.name for m in measures))


def buckets_of(spark: SparkSession) -> int:
    """Buckets of the stored rows."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(combined: Combined, folder: str) -> Combined:
    """Both tables below ``folder``; states are bucketed by id, so that no mart shuffles ids again."""
    spark = combined.states.sparkSession
    buckets = buckets_of(spark)
    name = f"offer_states_{uuid.uuid4().hex}"
    combined.states.repartition(buckets, "id_offre").write.bucketBy(buckets, "id_offre").option(
        "path", f"{folder}/states").saveAsTable(name)
    combined.origins.write.parquet(f"{folder}/origins")
    return Combined(spark.table(name), spark.read.parquet(f"{folder}/origins"), combined.conditions)


def _as_combined(offers: DataFrame | Combined, measures: Sequence[Measure]) -> Combined:
    return offers if isinstance(offers, Combined) else combine(offers, measures, pay=False)


def _counts(combined: Combined, keys: Mapping[str, Column], names: Sequence[str], total: str,
            spread: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Distinct ids in total and per condition, the carried sums and bounds, covered areas and lineage per key."""
    masks = [c for c in combined.states.columns if c.startswith("_mask")]
    sums = [c for c in combined.states.columns if c.endswith(("_somme", "_nombre", "_min", "_max"))]

    def merged(name: str) -> Column:
        how = F.min if name.endswith("_min") else F.max if name.endswith("_max") else F.sum
        return how(name).alias(name)

    per_id = spread(combined.states).select(
        *[c.alias(n) for n, c in keys.items()], F.col("id_offre").alias("_id"), *masks, *sums
    ).groupBy(*keys, "_id").agg(*[F.bit_or(n).alias(n) for n in masks], *map(merged, sums))
    is_id, place = F.col("_id").isNotNull(), {n: _place(i) for i, n in enumerate(combined.conditions)}

    def fulfilled(name: str) -> Column:
        mask, bit = place[name]
        return F.col(mask).bitwiseAND(F.lit(bit).cast("long")) != 0

    counted = per_id.groupBy(*keys).agg(
        F.count_if(is_id).alias(total),
        *[F.count_if(is_id & fulfilled(n)).alias(n) for n in names],
        *map(merged, sums))
    code = [F.count_distinct("_code").alias(COVERED)] if "code_departement" in combined.origins.columns else []
    origins = combined.origins.withColumn("_code", F.col("code_departement")) if code else combined.origins
    origins = spread(origins).select(
        *[c.alias(f"_k_{n}") for n, c in keys.items()], *(["_code"] if code else []), *LINEAGE)
    origins = origins.groupBy(*[f"_k_{n}" for n in keys]).agg(*[F.max(n).alias(n) for n in LINEAGE], *code)
    if not keys:
        return counted.crossJoin(origins)  # one row each
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_k_{n}")) for n in keys])
    return counted.join(origins, same, "left").drop(*[f"_k_{n}" for n in keys])


def _with_means(counted: DataFrame) -> DataFrame:
    return counted.withColumns({n: rates.mean(F.col(f"{n}_somme"), F.col(f"{n}_nombre")) for n in MEANS})


def _with_shares(measures: Sequence[Measure], total: str) -> list[Column]:
    columns = []
    for m in measures:
        columns.append(F.col(m.name))
        if m.share:
            columns.append(rates.share(F.col(m.name), F.col(total)).alias(m.share))
    return columns


def _stamp(computed_at: datetime | None) -> list[Column]:
    return [(F.lit(computed_at) if computed_at else F.current_timestamp()).alias("date_calcul_kpi")]


def market_kpis(offers: DataFrame | Combined, computed_at: datetime | None = None) -> DataFrame:
    """One row over all offers."""
    measures, total = kpi_measures(), "nombre_total_offres"
    counted = _with_means(_counts(_as_combined(offers, measures), {}, [m.name for m in measures], total))
    return counted.select(
        *_stamp(computed_at), *LINEAGE, total, *_with_shares(measures, total), COVERED, *MEANS)


def grouped(offers: DataFrame | Combined, mart: Mart, computed_at: datetime | None = None) -> DataFrame:
    """Counts, shares and rank per group.

    The grand total is a distinct count over all offers: an id of several groups counts in each group but once in the
    total. The rank window has no partition, on the handful of rows left after aggregation.
    """
    total, combined = "nombre_offres", _as_combined(offers, mart.measures)
    counted = _with_means(_counts(
        combined, {out: F.col(c) for out, c in mart.keys.items()}, [m.name for m in mart.measures], total))
    everything = combined.states.select("id_offre").distinct().agg(F.count("id_offre").alias("_all"))
    last = F.when(F.col(mart.unknown[0]) == mart.unknown[1], 1).otherwise(0) if mart.unknown else F.lit(0)
    order = Window.orderBy(last, F.col(total).desc(), F.col(next(iter(mart.keys))))
    return (
        counted.crossJoin(everything)
        .select(
            *_stamp(computed_at),
            F.row_number().over(order).alias(mart.rank),
            *mart.keys,
            *LINEAGE,
            total,
            rates.share(F.col(total), F.col("_all")).alias("part_offres_pct"),
            *([COVERED] if mart.covers_areas else []),
            *_with_shares(mart.measures, total),
            *MEANS,
        )
        .orderBy(mart.rank)
    )


def _family() -> Mart:
    return Mart(
        keys={"famille_metier_data": "famille_metier_data"},
        measures=[*contracts("_dans_famille"), salary_stated(), salary_missing(), *signals(), *classes()],
        rank="rang_famille_metier",
    )


def _contract() -> Mart:
    return Mart(
        keys={"categorie_contrat": "categorie_contrat"},
        measures=[*families("_dans_contrat"), salary_stated(), salary_missing(), *signals(), *classes()],
        rank="rang_type_contrat",
    )


def _area() -> Mart:
    return Mart(
        keys={
            "code_departement": "code_departement_mart",
            "nom_departement": "nom_departement_mart",
            "code_region": "code_region_mart",
            "nom_region": "nom_region_mart",
        },
        measures=[*families(unshared=("autre_data_numerique",)), *contracts(), salary_stated(),
                  *signals(), *classes()],
        rank="rang_departement",
        covers_areas=False,
        unknown=("code_departement", rules.NO_AREA),
    )


def _region() -> Mart:
    return Mart(
        keys={"code_region": "code_region_mart", "nom_region": "nom_region_mart"},
        measures=[*families(), *contracts(), salary_stated(), salary_missing(), *signals(), *classes()],
        rank="rang_region",
        unknown=("code_region", rules.NO_REGION),
    )


def by_family(offers: DataFrame | Combined, computed_at: datetime | None = None) -> DataFrame:
    """Equal volumes rank by label, so that ranks are the same on every run."""
    return grouped(offers, _family(), computed_at)


def by_contract(offers: DataFrame | Combined, computed_at: datetime | None = None) -> DataFrame:
    return grouped(offers, _contract(), computed_at)


def by_area(placed: DataFrame | Combined, computed_at: datetime | None = None) -> DataFrame:
    """``placed``: offers after ``dimension.attach_area``. The unknown area ranks last."""
    return grouped(placed, _area(), computed_at)


def by_region(placed: DataFrame | Combined, computed_at: datetime | None = None) -> DataFrame:
    return grouped(placed, _region(), computed_at)


# Axes of the salary mart: order, axis, code when missing, label when missing.
GLOBAL_AXIS = (1, "Global", "GLOBAL", "Ensemble")
CATEGORY_AXES = (
    (2, "Famille métier", "famille_metier_data"),
    (3, "Type de contrat", "categorie_contrat"),
)
REGION_AXIS = (4, "Région")
AXIS_KEYS = ("ordre_axe", "axe_analyse", "code_modalite", "modalite")
QUARTILES = {"premier_quartile": 0.25, "salaire_annuel_median": 0.5, "troisieme_quartile": 0.75}


AXIS_SOURCE = (*(column for _, _, column in CATEGORY_AXES), "code_region_mart", "nom_region_mart")


def unpivot_axes(facts: DataFrame) -> DataFrame:
    """Each row once per axis, its category columns replaced by the axis columns."""

    def axis(order: int, name: str, code: Column, label: Column) -> Column:
        return F.struct(F.lit(order).alias("ordre_axe"), F.lit(name).alias("axe_analyse"),
                        code.alias("code_modalite"), label.alias("modalite"))

    order, name, code, label = GLOBAL_AXIS
    axes = [axis(order, name, F.lit(code), F.lit(label))]
    for order, name, column in CATEGORY_AXES:
        axes.append(axis(order, name, F.coalesce(column, F.lit(rules.NO_AREA)),
                         F.coalesce(column, F.lit(rules.UNKNOWN))))
    axes.append(axis(*REGION_AXIS, F.col("code_region_mart"), F.col("nom_region_mart")))
    return facts.withColumn("_axis", F.explode(F.array(*axes))).select(
        *[F.col(f"_axis.{k}").alias(k) for k in AXIS_KEYS],
        *[c for c in facts.columns if c not in AXIS_SOURCE],
    )


def salary_analysis(facts: DataFrame, computed_at: datetime | None = None, combined: Combined | None = None) -> DataFrame:
    """Volumes, transparency and pay distribution per value of four axes.

    ``facts``: offers with salary facts (``salaries.attach_facts`` or ``join_facts``) and areas; ``combined`` has their
    combined rows, if they are stored. Combined rows are spread over the axes and counted per id.
    """
    central = "salaire_annuel_central"
    usable = flags.is_true(F.col("salaire_exploitable"))
    keys, regroup = list(AXIS_KEYS), (AXIS_SOURCE, unpivot_axes)
    volumes = _counts(combined or combine(facts, salary_measures()), {k: F.col(k) for k in keys},
                      [m.name for m in salary_measures()], "nombre_offres", unpivot_axes)
    # Usable pay lies between 0 and the outlier threshold and has two decimals: 10,000 values per 100 units at most.
    quartiles = aggregates.exact_quantiles(facts, keys, central, QUARTILES, usable, 100.0, regroup)
    # The global row among the few aggregated ones; a window, so that nothing is computed twice.
    everything = F.max(F.when(F.col("ordre_axe") == GLOBAL_AXIS[0], F.col("nombre_offres"))).over(
        Window.partitionBy()
    )
    n, total = F.col, F.col("nombre_offres")
    order = Window.partitionBy("axe_analyse").orderBy(total.desc(), "modalite")
    money = {q: F.round(F.col(q), 2).cast("decimal(28,2)") for q in QUARTILES}
    return (
        volumes.join(quartiles, keys, "left")
        .withColumns({**money, "_all": everything})
        .select(
            *_stamp(computed_at),
            "ordre_axe",
            "axe_analyse",
            F.row_number().over(order).alias("rang_modalite"),
            "code_modalite",
            "modalite",
            *LINEAGE,
            "nombre_offres",
            rates.share(total, n("_all")).alias("part_offres_pct"),
            "nombre_salaires_renseignes",
            rates.share(n("nombre_salaires_renseignes"), total).alias("taux_transparence_salariale_pct"),
            "nombre_salaires_exploitables",
            rates.share(n("nombre_salaires_exploitables"), total).alias(
                "taux_salaires_exploitables_sur_total_pct"),
            rates.share(n("nombre_salaires_exploitables"), n("nombre_salaires_renseignes")).alias(
                "taux_exploitabilite_salaires_renseignes_pct"),
            "nombre_salaires_suspects",
            "nombre_salaires_non_exploitables",
            rates.mean(n("paie_somme"), n("paie_nombre")).alias("salaire_annuel_moyen"),
            "salaire_annuel_median",
            "premier_quartile",
            "troisieme_quartile",
            (n("troisieme_quartile") - n("premier_quartile")).alias("ecart_interquartile"),
            n("paie_min").alias("salaire_annuel_min_observe"),
            n("paie_max").alias("salaire_annuel_max_observe"),
        )
        .orderBy("ordre_axe", "rang_modalite")
    )
