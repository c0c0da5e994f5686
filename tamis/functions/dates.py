"""Tolerant date parsing and day arithmetic (the session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INGESTION_FORMAT = "yyyy-MM-dd_HH-mm-ss"


def to_instant(col: Column, fmt: str | None = None) -> Column:
    """Timestamp from text; unparsable text gives null and the row stays."""
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def not_before(later: Column, earlier: Column) -> Column:
    """Three-valued: null as soon as one side is unknown."""
    return later >= earlier


def reference_date(ingested: Column, loaded: Column) -> Column:
    return F.coalesce(F.to_date(ingested), F.to_date(loaded))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, never negative, null if either is null.

    The guard is needed: ``greatest`` skips nulls and would answer 0.
    """
    days = F.datediff(F.to_date(end), F.to_date(start))
    return F.when(days.isNotNull(), F.greatest(F.lit(0), days))


def within_days(moment: Column, reference: Column, days: int) -> Column:
    """On or after ``reference - days``; unknown dates give false, later dates give true."""
    return F.coalesce(F.to_date(moment) >= F.date_sub(reference, days), F.lit(False))
