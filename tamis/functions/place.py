"""Area code from commune code, postcode or place label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.text import first_match

# Shapes of French commune codes, postcodes and place labels.
OVERSEAS_GROUP = r"97[1-4]"
OVERSEAS_SINGLE = "976"
MAINLAND = r"(0[1-9]|[1-8][0-9]|9[0-5])"
CORSICA = ("2A", "2B")


def _from_digits(code: Column) -> list[tuple[Column, Column]]:
    return [
        (code.rlike(f"^{OVERSEAS_GROUP}"), F.left(code, F.lit(3))),
        (code.startswith(OVERSEAS_SINGLE), F.lit(OVERSEAS_SINGLE)),
        (code.rlike(rf"^{MAINLAND}[0-9]{{3}}\z"), F.left(code, F.lit(2))),
    ]


def area_code(commune: Column, postcode: Column, label: Column) -> Column:
    """Most precise source first; null when none gives a known shape.

    A Corsican postcode (20xxx) gives ``20``, which no reference row carries: such rows need the
    commune code or the label to be placed.
    """
    commune, postcode, label = F.trim(commune), F.trim(postcode), F.trim(label)
    rules = [(F.upper(commune).startswith(c), F.lit(c)) for c in CORSICA]
    rules += _from_digits(commune) + _from_digits(postcode)
    rules += [(F.upper(label).rlike(rf"^{c}\s*-"), F.lit(c)) for c in CORSICA]
    rules += [
        (label.rlike(rf"^{OVERSEAS_GROUP}\s*-"), F.left(label, F.lit(3))),
        (label.rlike(rf"^{OVERSEAS_SINGLE}\s*-"), F.lit(OVERSEAS_SINGLE)),
        (label.rlike(rf"^{MAINLAND}\s*-"), F.left(label, F.lit(2))),
    ]
    return first_match(rules)
