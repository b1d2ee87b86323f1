"""District id (AUN) formats: dashed ``ddd-dd-ddd-d``, plain 9 digits, numeric."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The valid dashed district id.
AUN_PATTERN = r"^\d{3}-\d{2}-\d{3}-\d{1}$"
# 9 digits split into the dashed groups.
AUN_DIGITS = r"^(\d{3})(\d{2})(\d{3})(\d{1})$"
AUN_DASHED = "$1-$2-$3-$4"
# District ids carried in file names.
# Student-upload files: 9 digits after the last ``_1_`` and before the next ``_``.
UPLOAD_FILE_AUN = r"^.*_1_(\d{9})_.*\.csv$"
# Meal-system files: 9 digits after a leading ``x``.
MEAL_FILE_AUN = r"^x(\d{9}).*"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plain_aun(c) -> Column:
    """Drop every dash."""
    return F.regexp_replace(_c(c), "-", "")


def numeric_aun(c) -> Column:
    """Plain id as a number; bad text gives NULL (never raises under ANSI)."""
    return plain_aun(c).try_cast("double")


def format_aun(c) -> Column:
    """9 digits -> ``ddd-dd-ddd-d``; anything else unchanged."""
    return F.regexp_replace(_c(c), AUN_DIGITS, AUN_DASHED)


def valid_aun(c) -> Column:
    """TRUE for a dashed id; NULL counts as invalid."""
    return F.coalesce(_c(c).rlike(AUN_PATTERN), F.lit(False))


def aun_from_filename(c, pattern: str = UPLOAD_FILE_AUN) -> Column:
    """Replace a name matching ``pattern`` by its captured id; other names pass unchanged."""
    return F.regexp_replace(_c(c), pattern, "$1")
