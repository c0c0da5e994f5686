"""Null-aware booleans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions import text

# Spellings accepted for a boolean.
TRUE_WORDS = ("true", "1", "yes", "oui")
FALSE_WORDS = ("false", "0", "no", "non")


def is_true(col: Column) -> Column:
    """SQL ``is true``: null counts as false."""
    return F.coalesce(col, F.lit(False))


def is_not_true(col: Column) -> Column:
    """SQL ``is not true``: null counts as not true."""
    return ~is_true(col)


def present(*cols: Column) -> Column:
    """All of the columns are filled."""
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def any_present(*cols: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.isNotNull() for c in cols])


def status(col: Column, yes: str, no: str) -> Column:
    return F.when(is_true(col), F.lit(yes)).otherwise(F.lit(no))


def boolean_or_null(col: Column) -> Column:
    """Accepted spelling -> boolean; anything else -> null."""
    word = F.lower(text.strip(col.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def is_bad_boolean(col: Column) -> Column:
    """Filled, but not one of the accepted spellings."""
    return col.isNotNull() & boolean_or_null(col).isNull()


def to_boolean(col: Column) -> Column:
    """Strict form: an unknown spelling fails the job, null stays null."""
    message = F.concat(F.lit("not a boolean: "), col.cast("string"))
    return F.when(is_bad_boolean(col), F.raise_error(message).cast("boolean")).otherwise(boolean_or_null(col))


def score(*tests: Column) -> Column:
    """Number of tests that hold."""
    return reduce(lambda a, b: a + b, [is_true(t).cast("int") for t in tests])
