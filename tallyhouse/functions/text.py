"""Text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"^\s*$")


def contains_ignoring_case(needle: str, *columns: Column) -> Column:
    """True where any column holds the text, case ignored; NULL columns do not match."""
    wanted = F.lit(needle.strip().lower())
    hits = [F.contains(F.lower(F.coalesce(c.cast("string"), F.lit(""))), wanted) for c in columns]
    return reduce(lambda a, b: a | b, hits)


def fallback_email(first: Column, last: Column, domain: str) -> Column:
    """``first.last@domain`` in lower case; a missing name part reads ``none``."""
    part = lambda c: F.lower(F.coalesce(c, F.lit("none")))
    return F.concat(part(first), F.lit("."), part(last), F.lit("@" + domain))
