"""Text expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind, not blanks alone."""
    return F.regexp_replace(F.regexp_replace(col(c), r"(?U)^\s+", ""), r"(?U)\s+$", "")


def fold(c: str | Column) -> Column:
    """Case-insensitive comparison key; NULL counts as blank."""
    return F.lower(F.coalesce(col(c), F.lit("")))


def blank(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(""))


def or_default(c: str | Column, default: str) -> Column:
    """The value, or ``default`` when it is NULL or empty."""
    return F.when(F.length(col(c)) > 0, col(c)).otherwise(F.lit(default))


def cut_text(c: str | Column, n: int) -> Column:
    return F.substring(blank(c), 1, n)


def contains_any(c: str | Column, words: Sequence[str]) -> Column:
    """Literal, case-insensitive containment of any of ``words``."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(fold(c), F.lit(word.lower()))
    return found


def matches_keywords(c: str | Column, words: Sequence[str]) -> Column:
    """Case-insensitive alternation of escaped keywords."""
    pattern = "|".join(re.escape(w) for w in words if w)
    return col(c).rlike("(?iu)" + pattern) if pattern else F.lit(False)


def clean_words(words: Sequence[str | None], cap: int | None = None) -> list[str]:
    """Request words stripped, lowered, without blanks; ``cap`` keeps the first of them only."""
    return [w.strip().lower() for w in words if w and w.strip()][:cap]


def lacks_text(c: str | Column) -> Column:
    """True for the three spellings of a missing description."""
    return F.coalesce(col(c).isin("", "N/A"), F.lit(True))


def is_valid(c: str | Column) -> Column:
    """A NULL validity flag means valid."""
    return F.coalesce(col(c), F.lit(True))


def display_name(original: str | Column = "original_name", name: str | Column = "name") -> Column:
    return F.coalesce(col(original), col(name))
