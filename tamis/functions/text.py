"""Text cleaning and rule matching."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Strip all Unicode white space (Spark's one-argument ``trim`` strips spaces only)."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean(col: Column) -> Column:
    """Stripped text, null when nothing is left. Case is kept."""
    return F.nullif(strip(col), F.lit(""))


def is_blank(col: Column) -> Column:
    """Null, empty or only white space. Never null."""
    return F.coalesce(F.length(strip(col)) == 0, F.lit(True))


def joined(*cols: Column) -> Column:
    """Parts joined by one space, a null part counting as '' (``concat_ws`` would drop its space)."""
    parts: list[Column] = []
    for col in cols:
        parts += [F.lit(" "), F.coalesce(col, F.lit(""))]
    return F.concat(*parts[1:])


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """True if any needle occurs. Plain substring search: no regex engine on long texts."""
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def has_word(text: Column, word: str) -> Column:
    """``word`` bounded by characters that are neither letters nor digits in any script.

    The pattern starts with the literal, so the regex engine looks at character classes only
    where the word itself occurs.
    """
    other = r"[\p{L}\p{N}]"
    return text.rlike(f"{word}(?<!{other}{word})(?!{other})")


def first_match(rules: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """Ordered cascade: value of the first rule whose condition holds."""
    chain = None
    for condition, value in rules:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(F.lit(default) if not isinstance(default, Column) else default)


def classify(text: Column, families: Iterable[tuple[str, tuple[str, ...], tuple[str, ...]]], other: str) -> Column:
    """First family with a matching substring or whole word, in list order."""
    rules = []
    for label, needles, words in families:
        hit = contains_any(text, needles)
        for word in words:
            hit = hit | has_word(text, word)
        rules.append((hit, F.lit(label)))
    return first_match(rules, other)


def label_list(text: Column, labels: Iterable[tuple[str, tuple[str, ...]]]) -> Column:
    """Labels whose needles occur, in list order, joined with ', '; null when none does."""
    found = [F.when(contains_any(text, needles), F.lit(label)) for label, needles in labels]
    return F.nullif(F.concat_ws(", ", *found), F.lit(""))
