"""Text cleaning and NA-aware concatenation, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set trimmed from both ends (space, tab, CR, LF).
TRIM_CHARS = " \t\r\n"

# The text a missing part becomes inside a built key.
NA_TEXT = "NA"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Trim spaces, tabs, CR and LF from both ends (``trim`` alone drops spaces only)."""
    return F.btrim(_c(c), F.lit(TRIM_CHARS))


def clean_text(c) -> Column:
    """Key cleaning: text, trimmed, lower case. NULL stays NULL."""
    return F.lower(trim_ws(_c(c).cast("string")))


def na_as_text(c) -> Column:
    """A missing value written as the text ``NA`` (so it still forms a key)."""
    return F.coalesce(_c(c).cast("string"), F.lit(NA_TEXT))


def paste_key(*parts, sep: str = "_") -> Column:
    """Join parts with ``sep``; a NULL part becomes ``NA`` rather than nulling the key."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(na_as_text(p))
    return F.concat(*pieces)


def blank_or_null(c) -> Column:
    """TRUE when NULL or the empty string."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def present(c) -> Column:
    """TRUE when neither NULL nor the empty string."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


# The replacement character decoders put in place of undecodable bytes.
REPLACEMENT_CHAR = "�"


def decodable_or_null(c) -> Column:
    """NULL when the text holds an undecodable byte (shown as U+FFFD), else the text."""
    c = _c(c)
    return F.when(F.instr(c, REPLACEMENT_CHAR) > 0, F.lit(None).cast("string")).otherwise(c)
