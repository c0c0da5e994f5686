"""JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_valid(col: Column) -> Column:
    """The text is exactly one JSON value. Null for null.

    The JSON functions stop after the first value and ignore what follows it. Inside a list, text
    that goes on is an error or a second element; inside an object, a bracket that closes the
    list early is an error. Both wrappers together leave only one complete value.
    """
    listed = F.concat(F.lit("["), col, F.lit("]"))
    held = F.concat(F.lit('{"v":'), col, F.lit("}"))
    parsed = F.try_parse_json(listed)
    one = F.try_variant_get(parsed, "$[0]", "variant").isNotNull() & F.try_variant_get(
        parsed, "$[1]", "variant").isNull()
    return F.when(
        col.isNotNull(),
        parsed.isNotNull() & F.try_parse_json(held).isNotNull() & F.coalesce(one, F.lit(False)),
    )


def parse(col: Column) -> Column:
    """VARIANT of a valid text, else null."""
    return F.when(is_valid(col), F.try_parse_json(col))


def canonical(col: Column) -> Column:
    """JSON text with sorted keys and no blanks, null if the text is not valid."""
    return F.to_json(parse(col))
