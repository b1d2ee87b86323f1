"""Address standardization before comparison (chained JVM regex rewrites, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmatch.functions.text import trim_ws

# Whole-word street types and their abbreviations, applied in this order.
STREET_ABBREVIATIONS: tuple[tuple[str, str], ...] = (
    ("street", "st"),
    ("avenue", "ave"),
    ("drive", "dr"),
    ("road", "rd"),
    ("lane", "ln"),
    ("court", "ct"),
    ("place", "pl"),
    ("boulevard", "blvd"),
)


def standardize_address(c) -> Column:
    """Lower case, trim, abbreviate whole-word street types, then drop every dot."""
    out = trim_ws(F.lower(F.col(c) if isinstance(c, str) else c))
    for word, abbr in STREET_ABBREVIATIONS:
        out = F.regexp_replace(out, rf"\b{word}\b", abbr)
    return F.regexp_replace(out, r"\.", "")
