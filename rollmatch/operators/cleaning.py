"""Row-level projections and filters on rosters (no shuffles)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.aun import format_aun, plain_aun, valid_aun
from rollmatch.functions.text import clean_text, present
from rollmatch.schema import KEY_FIELDS, Side


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix every column name (``keep`` names stay as they are)."""
    keep = set(keep)
    return df.select([F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def clean_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim (space, tab, CR, LF) and lower-case the named columns; NULL stays NULL."""
    return df.withColumns({c: clean_text(c) for c in cols})


def clean_side_keys(df: DataFrame, side: Side, fields: Sequence[str] = KEY_FIELDS) -> DataFrame:
    return clean_keys(df, side.cols(fields))


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every named column is neither NULL nor blank."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & present(c)
    return df.filter(cond)


def require_ids(df: DataFrame, side: Side) -> DataFrame:
    """Drop rows with a missing or blank district id or secure id."""
    return require(df, [side.col("aun9_3"), side.col("pasecureid")])


def with_label(df: DataFrame, name: str, value: str) -> DataFrame:
    """Constant label column (user type, source)."""
    return df.withColumn(name, F.lit(value))


def relabel(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the first ``len(names)`` columns by position; later columns keep their names."""
    cols = df.columns
    if len(cols) < len(names):
        raise ValueError(f"frame has {len(cols)} columns, needs at least {len(names)}")
    return df.toDF(*(list(names) + cols[len(names):]))


def valid_district_rows(df: DataFrame, aun_col: str) -> DataFrame:
    """Rows whose district id is a well-formed dashed id (NULL is invalid)."""
    return df.filter(valid_aun(aun_col))


def find_district(df: DataFrame, text: str, name_col: str = "sfa_name") -> DataFrame:
    """Rows whose district name contains ``text`` (NULL names drop)."""
    return df.filter(F.col(name_col).contains(text))


def districts_in(df: DataFrame, ids: Sequence, id_col: str = "AUN") -> DataFrame:
    """Rows whose id is in the given (small, literal) list."""
    return df.filter(F.col(id_col).isin(list(ids)))


def normalize_district_ids(df: DataFrame, side: Side) -> DataFrame:
    """Write every 9-digit district id in the dashed form, so both forms of one district
    form one key and one group (other text is left as it is)."""
    a = side.col("aun9_3")
    return df.withColumn(a, format_aun(plain_aun(a)))


def prepare_side(raw: DataFrame, side: Side, normalize_aun: bool = False, keep_flagged: str | None = None) -> DataFrame:
    """Intake on a raw roster: prefix, clean the seven key fields, require both ids.

    ``normalize_aun=True`` also writes 9-digit district ids dashed before keys are built
    (the original keeps the undashed and dashed forms of one district apart).
    ``keep_flagged`` names a boolean field whose rows stay even without ids, for a later check.
    """
    out = clean_side_keys(prefix_columns(raw, side.prefix), side)
    ids = present(side.col("aun9_3")) & present(side.col("pasecureid"))
    out = out.filter(ids | F.col(side.col(keep_flagged))) if keep_flagged else require_ids(out, side)
    return normalize_district_ids(out, side) if normalize_aun else out
