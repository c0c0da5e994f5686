"""Conditional distinct counts and exact quantiles that scale out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tamis.functions import flags as flag_fn
from tamis.session import scratch_path

_ID, _CODE, _LINEAGE, _TAG, _MASK = "_id", "_code", "_lineage", "_tag", "_mask"
_FACT_ROW, _CODE_ROW, _LINEAGE_ROW = 0, 1, 2

# Rows of a first aggregate by finer keys -> the same rows under the wanted keys, possibly several
# for one. Growing rows after an aggregate instead of before it keeps the big shuffle narrow.
Regroup = tuple[Sequence[str], Callable[[DataFrame], DataFrame]]


def distinct_counts(
    df: DataFrame,
    keys: Sequence[str],
    id_column: str,
    conditions: Mapping[str, Column],
    means: Mapping[str, Column] | None = None,
    covered: Mapping[str, Column] | None = None,
    lineage: Mapping[str, Column] | None = None,
    extremes: Mapping[str, Column] | None = None,
    total: str = "nombre_offres",
) -> DataFrame:
    """``count(distinct id)`` in total and under each condition, per key; one wide shuffle.

    * Conditions of one row become the bits of one long, so twenty of them cost eight bytes per
      row of shuffle. An id counts under a condition if any of its rows fulfils it.
    * ``means`` are row-level: ``<name>_somme`` and ``<name>_nombre`` carry sum and count;
      so are ``extremes``, with ``<name>_min`` and ``<name>_max``.
    * ``covered`` counts the distinct values of one more column, and ``lineage`` takes maxima.
      Each input row emits a second (third) row for them; those collapse in the map-side
      aggregate, so the shuffle hardly grows and the input is read once. Keeping lineage strings
      out of the aggregation buffers lets the big aggregation stay hash-based.
    * More than 62 conditions go to several masks.
    """
    means, covered, lineage = dict(means or {}), dict(covered or {}), dict(lineage or {})
    extremes = dict(extremes or {})
    if len(covered) > 1:
        raise ValueError("one covered column")
    keys = list(keys)
    bits = {name: (f"{_MASK}{i // 62}", 1 << i % 62) for i, name in enumerate(conditions)}
    masks = {f"{_MASK}{i}": F.lit(0).cast("long") for i in range(max(1, -(-len(conditions) // 62)))}
    for name, cond in conditions.items():
        mask, bit = bits[name]
        masks[mask] = masks[mask].bitwiseOR(F.when(cond, F.lit(bit)).otherwise(F.lit(0)).cast("long"))
    tags = [F.lit(_FACT_ROW)]
    if covered:
        tags.append(F.lit(_CODE_ROW))
    if lineage:
        tags.append(F.lit(_LINEAGE_ROW))

    code = next(iter(covered.values()), F.lit(None).cast("string"))
    origin = F.struct(*[c.alias(n) for n, c in lineage.items()]) if lineage else F.lit(None).cast("string")
    rows = df.select(
        *keys,
        F.col(id_column).alias(_ID),
        *[c.alias(n) for n, c in masks.items()],
        *[c.alias(n) for n, c in {**means, **extremes}.items()],
        code.alias(_CODE),
        origin.alias(_LINEAGE),
    )
    if len(tags) > 1:
        rows = rows.withColumn(_TAG, F.explode(F.array(*tags)))
        rows = rows.withColumns(
            {
                _ID: F.when(F.col(_TAG) == _FACT_ROW, F.col(_ID)),
                _CODE: F.when(F.col(_TAG) == _CODE_ROW, F.col(_CODE)),
                _LINEAGE: F.when(F.col(_TAG) == _LINEAGE_ROW, F.col(_LINEAGE)),
                **{n: F.when(F.col(_TAG) == _FACT_ROW, F.col(n)) for n in (*means, *extremes)},
            }
        )
    else:
        rows = rows.withColumn(_TAG, F.lit(_FACT_ROW))

    # One row per (key, id); hot ids and the code and lineage rows shrink before the shuffle.
    sums = {f"{n}_somme": F.sum(n) for n in means} | {f"{n}_nombre": F.count(n) for n in means}
    ends = {f"{n}_min": F.min(n) for n in extremes} | {f"{n}_max": F.max(n) for n in extremes}
    per_id = rows.groupBy(*keys, _TAG, _ID, _CODE, _LINEAGE).agg(
        *[F.bit_or(n).alias(n) for n in masks], *[c.alias(n) for n, c in (sums | ends).items()]
    )

    def merged(name: str) -> Column:
        how = F.min if name.endswith("_min") else F.max if name.endswith("_max") else F.sum
        return how(name).alias(name)

    is_id = F.col(_ID).isNotNull()
    counts = [F.count_if(is_id).alias(total)]
    counts += [
        F.count_if(is_id & (F.col(mask).bitwiseAND(F.lit(bit).cast("long")) != 0)).alias(name)
        for name, (mask, bit) in bits.items()
    ]
    counts += [F.count(_CODE).alias(name) for name in covered]
    carried = [merged(n) for n in sums | ends]
    if not lineage:
        return per_id.groupBy(*keys).agg(*counts, *carried)
    # Lineage stays a grouping column until only a handful of rows per key is left.
    per_origin = per_id.groupBy(*keys, _LINEAGE).agg(*counts, *carried)
    names = [c for c in per_origin.columns if c not in (*keys, _LINEAGE)]
    result = per_origin.groupBy(*keys).agg(
        *[F.max(f"{_LINEAGE}.{n}").alias(n) for n in lineage], *[merged(n) for n in names]
    )
    if keys:
        return result
    # Without keys an empty input still gives its one row, with zero counts.
    return result.withColumns(
        {n: F.coalesce(F.col(n), F.lit(0).cast("long")) for n in names if n not in sums | ends}
    )


def conditional_count(df: DataFrame, keys: Sequence[str], id_column: str, **conditions: Column) -> DataFrame:
    """Short form with null counting as not fulfilled."""
    return distinct_counts(df, keys, id_column, {n: flag_fn.is_true(c) for n, c in conditions.items()})


def filtered_stats(df: DataFrame, keys: Sequence[str], value: str, where: Column) -> DataFrame:
    """Mean, minimum and maximum over the rows that pass ``where``; groups without any keep a row."""
    kept = F.when(flag_fn.is_true(where), F.col(value))
    return df.groupBy(*keys).agg(
        F.sum(kept).alias("somme"),
        F.count(kept).alias("nombre"),
        F.min(kept).alias("minimum"),
        F.max(kept).alias("maximum"),
    )


CUTS = 256
LIMIT = 1_000_000


def _stretches(df: DataFrame) -> DataFrame:
    """Adds ``_sub``, the number of bounds (``_bounds``, none if null) up to the value, by binary search: a step per projection."""
    df = df.withColumn("_sub", F.lit(0))
    step = CUTS >> 1
    while step:
        above = F.coalesce((F.element_at("_bounds", F.col("_sub") + step) <= F.col("_v")).cast("int"), F.lit(0))
        df = df.withColumn("_sub", F.col("_sub") + above * step)
        step >>= 1
    return df.drop("_bounds")


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[Column, DataFrame]:
    """Null-safe condition on ``keys`` and the right side with its keys renamed; no not-null filter is derived from it."""
    right = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & left[k].eqNullSafe(right[f"_k_{k}"])
    return same, right


def _ends(keys: Sequence[str], by: str, parts: DataFrame) -> DataFrame:
    """Running end of every part of a group in order of ``by``, and the size of the whole group."""
    order = Window.partitionBy(*[F.col(k) for k in keys], *([] if keys else [F.lit(0)]))
    running = order.orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    return parts.withColumns({"_all": F.sum("_size").over(order), "_end": F.sum("_size").over(running)})


def _refined(counted: DataFrame, keys: Sequence[str], holds: Callable[[], Column], limit: int) -> DataFrame:
    """Rows of the stretches that hold a wanted rank, none with more than ``limit`` distinct values.

    A stretch is known by its group and ``_start``, the number of smaller values in the group; first the group itself.
    Round by round, longer ones are cut at approximate quantiles of their own values, and parts without a wanted rank
    leave. Values that no ``double`` tells apart cannot be cut; such a stretch stays as it is.
    """
    spark = counted.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "quantiles")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    counted = stored(counted)
    groups = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"), F.sum("_n").alias("_total"))
    most = groups.agg(F.max("_d")).first()[0] or 0
    same, totals = _same(counted, groups.drop("_d"), keys)
    live = counted.join(totals, same).select(*keys, "_v", "_n", F.lit(0).cast("long").alias("_start"), "_total")
    place = [*keys, "_start"]
    cuts = F.expr(f"array({', '.join(f'{i / CUTS}D' for i in range(1, CUTS))})")
    while most > limit:
        sizes = live.groupBy(*place).agg(F.count(F.lit(1)).alias("_d")).filter(F.col("_d") > limit)
        same, long = _same(live, sizes.drop("_d"), place)
        bounds = live.join(long, same, "left_semi").groupBy(*place).agg(F.percentile_approx("_v", cuts, 10 * CUTS).alias("_bounds"))
        same, bounds = _same(live, bounds, place)
        parted = _stretches(live.join(bounds, same, "left").select(*place, "_v", "_n", "_total", "_bounds"))
        parts = parted.groupBy(*place, "_total", "_sub").agg(F.sum("_n").alias("_size"), F.count(F.lit(1)).alias("_d"))
        parts = _ends(place, "_sub", parts).withColumns(
            {"_from": F.col("_start") + F.col("_end") - F.col("_size"), "_to": F.col("_start") + F.col("_end")})
        # One row per part: at most CUTS for a stretch.
        kept = stored(parts.filter(holds()).select(*place, "_sub", "_from", "_d"))
        same, on = _same(parted, kept.drop("_d"), [*place, "_sub"])
        live = stored(parted.join(on, same).select(*keys, "_v", "_n", F.col("_from").alias("_start"), "_total"))
        before, most = most, kept.agg(F.max("_d")).first()[0]
        if most >= before:
            break
    return live


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    where: Column | None = None,
    bucket: float | None = None,
    regroup: Regroup | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Interpolated exact quantiles per key, without ever holding one large group in one task.

    ``percentile`` keeps all distinct values of a group in the memory of one task. Here equal values are counted first
    (combined before the shuffle) and stored below ``spark.checkpoint.dir``. Groups of more than ``limit`` distinct
    values are cut into stretches, longer stretches again, and only those that hold a wanted rank go on, so that no task
    ranks more than ``limit`` values, however many a group has and however they are spread. ``bucket`` sets stretches of
    a fixed width instead, in one plan and with nothing stored.

    Groups without a value give no row; ranks use SQL's ``(n - 1) * q``.

    Rows that fail ``where`` become one null value per key and leave after the first aggregate. A
    filter before it would be pushed down with the whole expression behind ``where`` copied in.
    """
    keys = list(keys)
    by_key = [F.col(k) for k in keys]
    kept = F.when(flag_fn.is_true(where), F.col(value)) if where is not None else F.col(value)
    first_keys = list(regroup[0]) if regroup else keys
    counted = (
        df.select(*first_keys, kept.alias("_v"))
        .groupBy(*first_keys, "_v")
        .agg(F.count("_v").alias("_n"))
        .filter("_n > 0")
    )
    if regroup:
        counted = regroup[1](counted).groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"))

    def position(q: float) -> Column:
        return (F.col("_total") - 1) * F.lit(q)

    def holds() -> Column:
        wanted = F.array(*[f(position(q)).cast("long") for q in quantiles.values() for f in (F.floor, F.ceil)])
        return F.exists(wanted, lambda r: (r >= F.col("_from")) & (r < F.col("_to")))

    if bucket is None:
        live = _refined(counted, keys, holds, limit)
    else:
        counted = counted.withColumn("_sub", F.floor(F.col("_v") / F.lit(bucket)).cast("long"))
        # Offsets: one number per bucket.
        parts = _ends(keys, "_sub", counted.groupBy(*keys, "_sub").agg(F.sum("_n").alias("_size")))
        parts = parts.withColumns({"_total": F.col("_all"), "_from": F.col("_end") - F.col("_size"), "_to": F.col("_end")})
        needed = parts.filter(holds()).select(*keys, "_sub", F.col("_from").alias("_start"), "_total")
        # Null-safe, so that the two uses of ``counted`` share one shuffle.
        same, needed = _same(counted, needed, [*keys, "_sub"])
        live = counted.join(needed, same).select(*keys, "_v", "_n", "_start", "_total")
    inside = Window.partitionBy(*by_key, "_start").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = live.withColumn("_to", F.col("_start") + F.sum("_n").over(inside))
    ranked = ranked.withColumn("_from", F.col("_to") - F.col("_n"))

    def at(rank: Column) -> Column:
        rank = rank.cast("long")
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v")))

    pieces = ranked.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[at(F.floor(position(q))).alias(f"_lo_{n}") for n, q in quantiles.items()],
        *[at(F.ceil(position(q))).alias(f"_hi_{n}") for n, q in quantiles.items()],
    )
    numeric = dict(df.select(value).dtypes)[value]
    weight_type = "decimal(10,6)" if numeric.startswith("decimal") else "double"
    columns = []
    for n, q in quantiles.items():
        weight = (position(q) - F.floor(position(q))).cast(weight_type)
        low, high = F.col(f"_lo_{n}"), F.col(f"_hi_{n}")
        columns.append((low + (high - low) * weight).alias(n))
    return pieces.select(*keys, *columns)
