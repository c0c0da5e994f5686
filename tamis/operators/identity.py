"""Comparing two or more copies of a table by id: one shuffle of (id, hash), no joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.operators.checks import long_form

MOST_BUCKETS = 1 << 16  # of a comparison by buckets; their numbers are broadcast


def layer_bits(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per id with a bit per layer that holds it, and the row count per layer."""
    tagged = None
    for i, (df, key) in enumerate(layers.values()):
        rows = df.select(F.col(key).cast("string").alias("id"), F.lit(1 << i).alias("_bit"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    counts = [F.count_if(F.col("_bit") == (1 << i)).alias(f"lignes_{name}") for i, name in enumerate(layers)]
    return tagged.groupBy("id").agg(F.bit_or("_bit").alias("presence"), *counts)


def layer_identity(layers: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, ids, missing, null and duplicate ids per layer, and ids that some layer lacks."""
    everywhere = (1 << len(layers)) - 1
    named = F.col("id").isNotNull()
    rules = {"ids_incomplets": F.count_if(named & (F.col("presence") != everywhere))}
    for i, name in enumerate(layers):
        n, bit = F.col(f"lignes_{name}"), F.col("presence").bitwiseAND(1 << i) != 0
        rules |= {
            f"lignes_{name}": F.coalesce(F.sum(n), F.lit(0)),
            f"ids_{name}": F.count_if(named & bit),
            f"ids_nuls_{name}": F.coalesce(F.sum(F.when(~named, n)), F.lit(0)),
            f"ids_dupliques_{name}": F.coalesce(F.sum(F.when(named & (n > 1), n - 1)), F.lit(0)),
            f"ids_absents_{name}": F.count_if(named & ~bit),
        }
    return long_form(layer_bits(layers), rules)


def non_loss(before: tuple[DataFrame, str], after: tuple[DataFrame, str]) -> DataFrame:
    """Every row and id of one layer arrives in the next."""
    bits = layer_bits({"avant": before, "apres": after})
    b, a = F.col("lignes_avant"), F.col("lignes_apres")
    named = F.col("id").isNotNull()
    return long_form(
        bits,
        {
            "ecart_lignes": F.coalesce(F.abs(F.sum(b) - F.sum(a)), F.lit(0)),
            "ids_nuls": F.coalesce(F.sum(F.when(~named, a)), F.lit(0)),
            "ids_dupliques": F.coalesce(F.sum(F.when(named & (a > 1), a - 1)), F.lit(0)),
            "ids_absents": F.count_if(named & (a == 0)),
            "ids_inattendus": F.count_if(named & (b == 0)),
        },
    )


def id_examples(source: tuple[DataFrame, str], target: tuple[DataFrame, str], limit: int = 10) -> DataFrame:
    """Missing and extra ids: counts, and the first ``limit`` ids of each side as a report."""
    bits = layer_bits({"source": source, "cible": target}).filter("id is not null and presence <> 3")
    kind = F.when(F.col("presence") == 1, "absent").otherwise("en_trop")
    tagged = bits.select(kind.alias("ecart"), "id")
    totals = tagged.groupBy("ecart").agg(F.count("id").alias("nombre"))
    firsts = None
    for name in ("absent", "en_trop"):
        top = tagged.filter(F.col("ecart") == name).orderBy("id").limit(limit)
        firsts = top if firsts is None else firsts.unionByName(top)
    examples = firsts.groupBy("ecart").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("exemples"))
    return totals.join(examples, "ecart", "left")


def canonical(field: T.StructField) -> Column:
    """A value as text that is the same wherever the row is stored."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col, {"ignoreNullFields": "false"})
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.nullif(col, F.lit(float("nan")).cast(field.dataType)).cast("string")
    return col.cast("string")


def canonical_row(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """JSON of the columns in name order; nulls are written, or two different rows could agree."""
    names = sorted(columns or df.columns)
    return F.to_json(
        F.struct(*[canonical(df.schema[n]).alias(n) for n in names]), {"ignoreNullFields": "false"}
    )


def digest(value: Column) -> dict[str, Column]:
    """120 bits of SHA-256 as two numbers: fixed width keeps aggregates over them hash-based."""
    hexes = F.sha2(F.coalesce(value, F.lit("\x00")), 256)
    return {
        "h": F.conv(F.substring(hexes, 1, 15), 16, 10).cast("long"),
        "l": F.conv(F.substring(hexes, 16, 15), 16, 10).cast("long"),
    }


def compare_rows(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per id: ``statut`` identique, different, absent or en_trop.

    Rows shrink to id and hash before the shuffle and copies of an id combine on the map side, so
    neither wide rows nor a repeated id burden a task. Repeated ids agree if all copies agree.
    """
    names = list(columns or source.columns)
    sides = []
    for side, df in (("s", source), ("t", target)):
        numbers = digest(canonical_row(df, names))
        sides.append(df.select(
            F.col(key).cast("string").alias("id"), F.lit(side).alias("_side"),
            *[c.alias(f"_{n}") for n, c in numbers.items()],
        ))
    both = sides[0].unionByName(sides[1]).filter(F.col("id").isNotNull())
    grouped = both.groupBy("id").agg(
        F.count_if(F.col("_side") == "s").alias("_ns"),
        F.count_if(F.col("_side") == "t").alias("_nt"),
        *[f(f"_{c}").alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("h", "l")],
    )
    same = (F.col("min_h") == F.col("max_h")) & (F.col("min_l") == F.col("max_l"))
    status = (
        F.when(F.col("_nt") == 0, "absent")
        .when(F.col("_ns") == 0, "en_trop")
        .when(same, "identique")
        .otherwise("different")
    )
    return grouped.select("id", status.alias("statut"))


def _keyed_rows(df: DataFrame, key: str, names: Sequence[str], side: int, buckets: int) -> DataFrame:
    """Columns to compare, with ``_side`` (1 or -1) and the bucket of the id; rows without one are left out."""
    text = F.col(f"`{key}`").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    rows = df.filter(text.isNotNull()).select(text.alias("id"), row, F.lit(side).alias("_side"))
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))


def _both_sides(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None, buckets: int):
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"between 1 and {MOST_BUCKETS} buckets")
    names = sorted(columns or source.columns)
    return names, _keyed_rows(source, key, names, 1, buckets), _keyed_rows(target, key, names, -1, buckets)


def _balance(names: Sequence[str], sides: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Per key the rows of each side, and whether both hold the same rows as often: the signed sums of digests are 0.

    Sums do not depend on order and combine on the map side, so a task sends a row per key.
    """
    both = None
    for rows in sides:
        fields = rows.schema["_row"].dataType
        flat = rows.select("_bucket", "id", "_side", *[F.col(f"_row.`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
        values = [canonical(T.StructField(f"c{i}", fields[c].dataType)).alias(f"c{i}") for i, c in enumerate(names)]
        numbers = digest(F.to_json(F.struct("id", *values), {"ignoreNullFields": "false"}))
        signed = [(c * F.col("_side")).cast("decimal(20,0)").alias(f"_{n}") for n, c in numbers.items()]
        part = flat.select(*keys, "_side", *signed)
        both = part if both is None else both.unionByName(part)
    same = (F.sum("_side") == 0) & (F.sum("_h") == 0) & (F.sum("_l") == 0)
    return both.groupBy(*keys).agg(
        F.count_if(F.col("_side") > 0).alias("_ns"), F.count_if(F.col("_side") < 0).alias("_nt"), same.alias("_same"))


def differing_buckets(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, buckets: int = 4096,
) -> DataFrame:
    """``_bucket, lignes_source, lignes_cible`` of the buckets of ids in which two tables differ; at most ``buckets`` rows."""
    names, *sides = _both_sides(source, target, key, columns, buckets)
    found = _balance(names, sides, ["_bucket"]).filter(~F.col("_same"))
    return found.select("_bucket", F.col("_ns").alias("lignes_source"), F.col("_nt").alias("lignes_cible"))


def changed_rows(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, buckets: int = 4096,
) -> DataFrame:
    """One row per id that differs: ``statut`` different, absent or en_trop.

    Two levels of digests: buckets of ids first, then ids of the buckets that differ. Of equal tables only a row per task
    and bucket is shuffled, and the second level reads nothing; a changed row costs the shuffle of one bucket. Ids are
    compared by their copies: the same rows as often on both sides are no difference, whatever their order. Null ids are
    left out, as in ``compare_rows``. Empty tables are equal.
    """
    names, *sides = _both_sides(source, target, key, columns, buckets)
    only = F.broadcast(differing_buckets(source, target, key, columns, buckets).select("_bucket"))
    found = _balance(names, [s.join(only, "_bucket", "left_semi") for s in sides], ["id"]).filter(~F.col("_same"))
    status = F.when(F.col("_nt") == 0, "absent").when(F.col("_ns") == 0, "en_trop").otherwise("different")
    return found.select("id", status.alias("statut"))


def comparison_summary(compared: DataFrame, limit: int = 10) -> DataFrame:
    """Counts per outcome, and the first ``limit`` different ids as a report."""
    status = F.col("statut")
    counts = compared.agg(
        F.count_if(status.isin("identique", "different")).alias("lignes_comparees"),
        F.count_if(status == "different").alias("lignes_differentes"),
        F.count_if(status == "absent").alias("ids_absents"),
        F.count_if(status == "en_trop").alias("ids_en_trop"),
    )
    top = compared.filter(status == "different").orderBy("id").limit(limit)
    examples = top.agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("exemples_differents"))
    same = (F.col("lignes_differentes") + F.col("ids_absents") + F.col("ids_en_trop")) == 0
    return counts.crossJoin(examples).withColumn("contenu_identique", same)


def compare_schemas(source: DataFrame, target: DataFrame, extra: Sequence[str]) -> dict[str, object]:
    """Column sets of two tables; ``extra`` columns are expected in the target only."""
    s, t, e = set(source.columns), set(target.columns), set(extra)
    return {
        "colonnes_source": len(source.columns),
        "colonnes_cible": len(target.columns),
        "colonnes_attendues": len(s | e),
        "colonnes_absentes": sorted(s - t),
        "colonnes_techniques_absentes": sorted(e - t),
        "colonnes_inattendues": sorted(t - (s | e)),
        "schema_valide": t == (s | e),
    }


def schema_rows(source: DataFrame, target: DataFrame, extra: Sequence[str]) -> DataFrame:
    """One row per column with what the comparison found."""
    found = compare_schemas(source, target, extra)
    states = {"colonnes_absentes": "absente", "colonnes_techniques_absentes": "technique_absente",
              "colonnes_inattendues": "inattendue"}
    rows = [(c, state) for name, state in states.items() for c in found[name]]
    rows += [(c, "technique") for c in extra if c in target.columns]
    rows += [(c, "commune") for c in source.columns if c in target.columns and c not in extra]
    return source.sparkSession.createDataFrame(sorted(rows), "colonne string, etat string")


def target_metrics(df: DataFrame, key: str, single: Sequence[str], loaded_at: str) -> DataFrame:
    """Rows, keys and lineage of a stored snapshot in one row.

    Two narrow reads: counts per key, and counts per combination of lineage values. A healthy
    snapshot has one combination, so the second shrinks to one row per task; the distinct counts
    then run on what is left.
    """
    named = F.col(key).isNotNull()
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("nombre_lignes"),
        F.count_if(named).alias("ids_distincts"),
        F.coalesce(F.sum(F.when(~named, F.col("_n"))), F.lit(0)).alias("ids_manquants"),
        F.count_if(named & (F.col("_n") > 1)).alias("ids_dupliques"),
    )
    lineage = [*single, loaded_at]
    origins = df.groupBy(*lineage).agg(F.count(F.lit(1)).alias("_n"))
    columns = [F.coalesce(F.sum(F.when(F.col(loaded_at).isNull(), F.col("_n"))), F.lit(0)).alias(
        f"{loaded_at}_manquants")]
    for c in lineage:
        columns += [F.count_distinct(F.col(c)).alias(f"nombre_{c}"), F.min(c).alias(f"{c}_min"),
                    F.max(c).alias(f"{c}_max")]
    return keys.crossJoin(origins.agg(*columns))
