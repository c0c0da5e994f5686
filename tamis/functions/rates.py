"""Shares, rounded means and report rates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, total: Column) -> Column:
    """Percentage with two decimals, null when the total is zero. Exact decimal arithmetic."""
    ratio = F.lit(Decimal("100.0")) * part / F.nullif(total, F.lit(0).cast("long"))
    return F.round(ratio, 2).cast("decimal(7,2)")


def mean(total: Column, count: Column) -> Column:
    """Mean from a carried sum and count, two decimals, null over no rows."""
    ratio = total.cast("decimal(28,4)") / F.nullif(count, F.lit(0).cast("long"))
    return F.round(ratio, 2).cast("decimal(28,2)")


def report_rate(part: Column, total: Column, empty: float | None = None) -> Column:
    """Percentage of the profile reports: binary floating point, rounded half-even on its exact value.

    ``format_number`` rounds the exact binary value, ``round`` on a double does not.
    """
    rate = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0)
    rounded = F.regexp_replace(F.format_number(rate, 2), ",", "").cast("double")
    return F.coalesce(rounded, F.lit(empty).cast("double")) if empty is not None else rounded
