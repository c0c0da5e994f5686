"""Acquired JSON records to a flat table with a stable schema.

Records come as JSON text. Each is parsed once into a VARIANT, from which columns are read by
path, so fields nobody declared are kept as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamis.operators.checks import count_of, long_form
from tamis.presets import acquisition as preset

VALUE = "_value"
_WHOLE = "_whole"


def parse(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds the parsed record; malformed text gives null and is counted by ``record_checks``."""
    return records.withColumn(VALUE, F.try_parse_json(record))


def field(*keys: str, kind: str = "string") -> Column:
    """Value below nested keys: null if absent; objects and lists become compact JSON text."""
    path = "$" + "".join(f"['{key}']" for key in keys)
    return F.try_variant_get(F.col(VALUE), path, kind)


def struct_type(tree: Mapping[str, str | Mapping[str, str]]) -> str:
    """DDL of a struct of these fields."""
    fields = (f"`{n.replace('`', '``')}`: {struct_type(t) if isinstance(t, Mapping) else t}" for n, t in tree.items())
    return f"struct<{', '.join(fields)}>"


def json_text(col: Column) -> Column:
    """Text stays as it is, other structures become JSON text (for struct, array and map columns)."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def flatten(
    parsed: DataFrame,
    nested: Mapping[str, Sequence[str]] = preset.NESTED_FIELDS,
    scalars: Sequence[str] = preset.TEXT_FIELDS,
    json_fields: Sequence[str] = preset.JSON_FIELDS,
    types: Mapping[str, T.DataType] = preset.TYPED_FIELDS,
    extra: Sequence[str] = (),
    record: str = "record",
) -> DataFrame:
    """Declared columns always, plus the ``extra`` top-level keys of this batch.

    ``raw_record`` is the input text as it came. Comparisons bring it to a canonical form themselves.
    """

    children = {f"{parent}_{child}": (parent, child) for parent, kids in nested.items() for child in kids}
    declared = dict.fromkeys([*scalars, *(n for n in types if n not in children), *json_fields])
    paths = {name: (name,) for name in [*declared, *(n for n in extra if n not in declared and n not in nested)]}
    paths = {**children, **paths}

    def kind(name: str) -> str:
        return types[name].simpleString() if name in types else "string"

    tree: dict[str, str | dict[str, str]] = {}
    for name, (top, *below) in paths.items():
        if below:
            tree.setdefault(top, {})[below[0]] = kind(name)
        else:
            tree[top] = kind(name)
    # One walk over the fields of a record; a path of its own for each would search them again for every column.
    whole = F.try_variant_get(F.col(VALUE), "$", struct_type(tree))
    names = [n.lower() for n in tree] + [f"{n.lower()}.{k.lower()}" for n, kids in tree.items() if isinstance(kids, dict) for k in kids]
    walked = len(set(names)) == len(names)  # names that differ by case alone are read by path

    def typed(name: str, keys: tuple[str, ...]) -> Column:
        if not walked:
            return field(*keys, kind=kind(name)).alias(name)
        value = F.col(_WHOLE)
        for key in keys:
            value = value.getField(key)
        return value.alias(name)

    columns = [typed(name, keys) for name, keys in paths.items()]
    parsed = parsed.withColumn(_WHOLE, whole) if walked else parsed
    kept = [c for c in parsed.columns if c not in (VALUE, _WHOLE, record)]
    return parsed.select(*kept, *columns, F.col(record).alias("raw_record"))


def with_lineage(
    bronze: DataFrame,
    batch_id: str,
    processing_run_id: str,
    source_file: Column | str,
    source_key: Column | str,
    version: str = preset.BRONZE_VERSION,
) -> DataFrame:
    """Constant lineage columns; ``source_*`` may also be columns such as ``_metadata.file_path``."""

    def value(v: Column | str) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    return bronze.withColumns(
        {
            "batch_id": F.lit(batch_id),
            "processing_run_id": F.lit(processing_run_id),
            "bronze_schema_version": F.lit(version),
            "raw_source_file": value(source_file),
            "raw_source_object_key": value(source_key),
        }
    )


def top_level_keys(parsed: DataFrame) -> DataFrame:
    """Keys of the batch with the number of records that carry them."""
    # Keys come from the first level alone; the values need not become text.
    keys = F.explode(F.map_keys(F.try_variant_get(F.col(VALUE), "$", "map<string, variant>")))
    return parsed.select(keys.alias("cle")).groupBy("cle").agg(F.count(F.lit(1)).alias("enregistrements"))


def undeclared(parsed: DataFrame, nested: Mapping[str, Sequence[str]] = preset.NESTED_FIELDS,
               scalars: Sequence[str] = preset.TEXT_FIELDS, json_fields: Sequence[str] = preset.JSON_FIELDS,
               types: Mapping[str, T.DataType] = preset.TYPED_FIELDS) -> list[str]:
    """Action: top-level keys of a batch that no declaration names, sorted; as few as the schema has fields."""
    known = {*nested, *scalars, *json_fields, *types}
    return sorted(r["cle"] for r in top_level_keys(parsed).collect() if r["cle"] not in known)


def schema_drift(
    parsed: DataFrame, nested: Mapping[str, Sequence[str]] = preset.NESTED_FIELDS
) -> DataFrame:
    """Unexpected sub-keys and wrong types of the nested fields.

    ``bloquant`` marks a value that is no object; a new sub-key only warns, since the record
    itself is kept. One pass; (field, key) pairs combine before the shuffle.
    """
    def warning(name: str):
        return lambda key: F.struct(
            F.lit(name).alias("champ"), key.alias("cle"), F.lit(False).alias("bloquant"))

    found = []
    for name, expected in nested.items():
        value = field(name, kind="variant")
        filled = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))
        keys = F.map_keys(F.try_variant_get(value, "$", "map<string, variant>"))
        unexpected = F.array_except(keys, F.array(*[F.lit(e) for e in expected]))
        is_object = F.schema_of_variant(value).startswith("OBJECT")
        found.append(
            F.when(
                filled,
                F.when(
                    is_object,
                    F.transform(unexpected, warning(name)),
                ).otherwise(F.array(F.struct(
                    F.lit(name).alias("champ"), F.lit(None).cast("string").alias("cle"),
                    F.lit(True).alias("bloquant")))),
            )
        )
    empty = F.array().cast("array<struct<champ:string,cle:string,bloquant:boolean>>")
    rows = F.concat(*[F.coalesce(f, empty) for f in found])
    return (
        parsed.select(F.inline(rows))
        .groupBy("champ", "cle", "bloquant")
        .agg(F.count(F.lit(1)).alias("enregistrements"))
    )


def record_checks(parsed: DataFrame, queries: Sequence[str] | None = None) -> DataFrame:
    """Preconditions of a raw batch in one pass; with ``queries`` also the known-keyword rule."""
    kind = F.schema_of_variant(F.col(VALUE))
    words = field("search_keywords", kind="array<string>")
    # A key with a JSON null is as good as no key.
    raw_words = field("search_keywords")
    is_list = F.schema_of_variant(field("search_keywords", kind="variant")).startswith("ARRAY")
    view = parsed.select(
        F.coalesce(kind.startswith("OBJECT"), F.lit(False)).alias("objet"),
        F.nullif(field("id"), F.lit("")).alias("id"),
        F.nullif(field("search_keyword"), F.lit("")).alias("mot"),
        raw_words.alias("brut"),
        F.coalesce(is_list, F.lit(False)).alias("liste"),
        words.alias("mots"),
        F.nullif(field("ingestion_timestamp"), F.lit("")).alias("instant"),
    )
    obj, has_words = F.col("objet"), F.col("objet") & F.col("liste") & (F.size("mots") > 0)
    rules = {
        "lot_vide": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0),
        "entrees_non_objet": count_of(~obj),
        "sans_id": count_of(obj & F.col("id").isNull()),
        "sans_mot_cle": count_of(obj & F.col("mot").isNull()),
        "sans_liste_mots_cles": count_of(obj & F.col("brut").isNull()),
        "mots_cles_non_liste": count_of(obj & F.col("brut").isNotNull() & ~F.col("liste")),
        "mots_cles_vides": count_of(obj & F.col("liste") & (F.size("mots") == 0)),
        "mot_cle_hors_liste": count_of(
            has_words & F.col("mot").isNotNull() & ~F.array_contains("mots", F.col("mot"))
        ),
        "sans_instant": count_of(has_words & F.col("instant").isNull()),
        "instants_multiples": F.when(F.min("instant") == F.max("instant"), 0).otherwise(1),
    }
    if queries is not None:
        known = F.array(*[F.lit(q) for q in queries])
        rules["mots_cles_inconnus"] = count_of(has_words & (F.size(F.array_except("mots", known)) > 0))
    return long_form(view, rules, {"ids_dupliques": "id"})
