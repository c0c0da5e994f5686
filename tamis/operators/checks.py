"""Checks in long form: one row per rule with its number of violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import text

VALID, TO_REVIEW = "VALIDE", "A_CONTROLER"


class ContractError(ValueError):
    """A layer broke a rule that blocks the next one."""


def long_form(df: DataFrame, rules: Mapping[str, Column], unique: Mapping[str, str] | None = None) -> DataFrame:
    """All rules in one aggregate over ``df``; each rule is an aggregate expression.

    ``unique`` names rules that count rows beyond the first of each key. They are grouped counts of their own: next to
    minima of strings, a distinct count would sort all rows by key.
    """
    wide = df.agg(*[rule.cast("long").alias(name) for name, rule in rules.items()])
    for name, key in (unique or {}).items():
        wide = wide.crossJoin(repeats(df, key, name))
    return wide.unpivot([], [*rules, *(unique or {})], "controle", "violations")


def repeats(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row: rows beyond the first of each non-null key."""
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.sum(F.when(F.col("_key").isNotNull(), F.col("_n") - 1))
    return per_key.agg(F.coalesce(extra, F.lit(0)).cast("long").alias(name))


def count_of(condition: Column) -> Column:
    return F.count_if(condition)


def missing_key(column: str) -> Column:
    """Null or blank keys."""
    return F.count_if(text.is_blank(F.col(column).cast("string")))


def duplicate_key(column: str) -> Column:
    """Rows beyond the first of each non-null key."""
    return F.count(column) - F.count_distinct(F.col(column))


def not_single(column: str, expected: object | None = None) -> Column:
    """0 if the column holds exactly one value and no null (and that value is ``expected``).

    ``min = max`` needs no set of values, however many a bad batch holds.
    """
    good = (F.count_if(F.col(column).isNull()) == 0) & (F.min(column) == F.max(column))
    if expected is not None:
        good = good & (F.min(column) == F.lit(expected))
    return F.when(F.coalesce(good, F.lit(False)), 0).otherwise(1)


def required_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Names that are missing, sorted. Looks at the schema only."""
    return sorted(set(columns) - set(df.columns))


def assert_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = required_columns(df, columns)
    if missing:
        raise ContractError("missing columns: " + ", ".join(missing))
    return df


def problems(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("violations") != 0)


def assert_none(checks: DataFrame) -> DataFrame:
    """Action: fails with the broken rules. A check table has one row per rule."""
    broken = [f"{r['controle']}={r['violations']}" for r in problems(checks).collect()]
    if broken:
        raise ContractError("; ".join(sorted(broken)))
    return checks


def verdict(checks: DataFrame, good: str = VALID, bad: str = TO_REVIEW) -> DataFrame:
    """One row: status, number of broken rules and their names."""
    broken = F.array_sort(F.collect_list(F.when(F.col("violations") != 0, F.col("controle"))))
    return checks.agg(
        F.when(F.count_if(F.col("violations") != 0) == 0, good).otherwise(bad).alias("statut"),
        F.count_if(F.col("violations") != 0).alias("nombre_problemes"),
        F.array_join(broken, ", ").alias("problemes"),
    )


# Generic column tests


def not_null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def accepted(column: str, values: Sequence[object]) -> Column:
    """Filled values outside the list."""
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("nombre_lignes")).filter("nombre_lignes > 1")


def generic_tests(
    df: DataFrame,
    filled: Sequence[str] = (),
    unique: Sequence[str] = (),
    allowed: Mapping[str, Sequence[object]] | None = None,
) -> DataFrame:
    """not-null, unique and accepted-values tests.

    Filled and allowed rules share one pass. Each unique rule is a grouped count, so that a wide
    list of keys does not multiply the rows of that pass.
    """
    rules = {f"not_null_{c}": not_null(c) for c in filled}
    rules |= {f"accepted_values_{c}": accepted(c, v) for c, v in (allowed or {}).items()}
    result = long_form(df, rules) if rules else None
    for c in unique:
        repeated = duplicated(df.filter(F.col(c).isNotNull()), [c])
        one = repeated.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"unique_{c}").alias("controle"), "violations"
        )
        result = one if result is None else result.unionByName(one)
    return result


def orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Distinct fact codes without a dimension row. Distinct first: few codes reach the join."""
    codes = facts.select(fact_key).filter(F.col(fact_key).isNotNull()).distinct()
    known = dimension.select(F.col(dimension_key).alias(fact_key))
    return codes.join(known, fact_key, "left_anti")


def compare_totals(detail: DataFrame, detail_column: str, total: DataFrame, total_column: str) -> DataFrame:
    """Sum of a detail column against one stored total; a row only if they differ."""
    left = detail.agg(F.sum(detail_column).alias("somme_detail"))
    right = total.select(F.col(total_column).alias("total"))
    return left.crossJoin(right).filter(~F.col("somme_detail").eqNullSafe(F.col("total")))


def axis_violations(mart: DataFrame, axis: str, total: str, measures: Sequence[str]) -> DataFrame:
    """Measures whose sum over an axis differs from the row of axis ``total``."""
    sums = mart.unpivot([axis], list(measures), "mesure", "_value").groupBy(axis, "mesure").agg(
        F.sum("_value").alias("somme"))
    expected = sums.filter(F.col(axis) == total).select("mesure", F.col("somme").alias("attendu"))
    found = sums.filter(F.col(axis) != total).join(expected, "mesure", "left")
    return found.filter(~F.col("somme").eqNullSafe(F.col("attendu"))).select(axis, "mesure", "somme", "attendu")


def unlabelled(mart: DataFrame, code: str, label: str, no_code: str, no_label: str) -> DataFrame:
    """Codes without the label of the reference."""
    missing = F.col(label).isNull() | (F.col(label) == no_label)
    return mart.filter(~F.col(code).eqNullSafe(F.lit(no_code)) & missing).select(code)


def one_positive_row(mart: DataFrame, volume: str) -> DataFrame:
    """A mart of exactly one row with a positive volume."""
    return long_form(mart, {
        "nombre_de_lignes": F.when(F.count(F.lit(1)) == 1, 0).otherwise(1),
        "volume_non_positif": F.count_if(F.coalesce(F.col(volume), F.lit(0)) <= 0)})


def share_sum(mart: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """The sum of shares if it lies outside the tolerance."""
    return mart.agg(F.sum(column).cast("double").alias("total_part_pct")).filter(
        (F.col("total_part_pct") < low) | (F.col("total_part_pct") > high)
    )


def parts_of_total(mart: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Rows whose parts do not add up to their total."""
    added = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return mart.filter(added != F.col(total))
