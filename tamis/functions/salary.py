"""Reading of free-text salary labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,4)"

# Periods, label grammar, reasons and method names.
PERIOD = r"(?i)\A\s*(Annuel|Mensuel|Horaire)"
# (?s) and \z because the comment may hold line breaks and only the real end of text may end it.
LABEL = (
    r"(?s)\A(Annuel|Mensuel|Horaire)\s+de\s+([0-9]+\.?[0-9]*)\s+Euros"
    r"(?:\s+à\s+([0-9]+\.?[0-9]*)\s+Euros)?"
    r"(?:\s+sur\s+([0-9]+\.?[0-9]*)\s+mois)?"
    r"(?:\s+-\s+.*)?\z"
)
YEARLY, MONTHLY, HOURLY = "Annuel", "Mensuel", "Horaire"
MONTHS_PER_YEAR = 12


def period_of(label: Column) -> Column:
    """Leading period word with its normal capital, null when there is none."""
    return F.initcap(F.nullif(F.regexp_extract(label, PERIOD, 1), F.lit("")))


def part(label: Column, group: int) -> Column:
    """One group of the label grammar, null when the label does not match or the group is absent."""
    return F.nullif(F.regexp_extract(F.trim(label), LABEL, group), F.lit(""))


def amount(label: Column, group: int) -> Column:
    return part(label, group).try_cast(MONEY)


def annual(period: Column, value: Column) -> Column:
    """Yearly amount; hourly amounts are not converted."""
    return (
        F.when(period == YEARLY, value)
        .when(period == MONTHLY, value * MONTHS_PER_YEAR)
        .cast(MONEY)
    )


def midpoint(low: Column, high: Column) -> Column:
    return F.round((low + high) / 2, 2).cast("decimal(28,2)")
