"""Match keys, missing counts, and de-duplication by key.

Shuffle notes
-------------
* ``dedup_by_key`` is ``row_number() == 1`` over ``join_key``; Catalyst plans a
  partial ``WindowGroupLimit`` before the exchange, so every map task ships at
  most one row per key. A key built from missing parts (``aun_NA_NA_NA``) that
  holds a third of all rows therefore costs one row per map task, not a third
  of the data in one task.
* ``key_table`` aggregates a side once per key (map-side combined). Written to the
  shared checkpoint folder, it is a plain input of the joins that need every row
  (``duplicate_flags`` here, ``unmatched`` in ``operators.matching``): both sides of
  such a join then come straight from a shuffle, which is what AQE's skew-join rule
  splits. An aggregate between the shuffle and the join would rule that out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.text import paste_key
from rollmatch.schema import INTAKE_NAMES, Side

POLICIES = ("name_dob", "by_id_length")
# The secure-id length that makes the id usable as a key.
SECURE_ID_LENGTH = 10


def match_key_columns(side: Side, policy: str = "name_dob") -> dict[str, Column]:
    """``join_key1`` = district_id; ``join_key2`` = district_first_last_dob; ``join_key``.

    ``policy="name_dob"`` always uses ``join_key2`` (what the original scripts do,
    because their length test is always true); ``"by_id_length"`` uses
    ``join_key1`` when the secure id has exactly 10 characters (the stated intent).
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    c = side.col
    key1 = paste_key(c("aun9_3"), c("pasecureid"))
    key2 = paste_key(c("aun9_3"), c("student_first_name"), c("student_last_name"), c("student_dob"))
    if policy == "name_dob":
        key = key2
    else:
        id_ok = F.coalesce(F.length(c("pasecureid")) == SECURE_ID_LENGTH, F.lit(False))
        key = F.when(id_ok, key1).otherwise(key2)
    return {c("join_key1"): key1, c("join_key2"): key2, "join_key": key}


def with_match_key(df: DataFrame, side: Side, policy: str = "name_dob") -> DataFrame:
    return df.withColumns(match_key_columns(side, policy))


def missing_count(side: Side, fields: Sequence[str] = INTAKE_NAMES) -> Column:
    """Number of NULL fields in the row (blank text is not missing)."""
    # one SQL expression: a single JVM call however many fields there are
    return F.expr(" + ".join(f"CAST(`{side.col(f)}` IS NULL AS INT)" for f in fields))


def with_missing_count(df: DataFrame, side: Side, fields: Sequence[str] = INTAKE_NAMES) -> DataFrame:
    return df.withColumn(side.col("missing_count"), missing_count(side, fields))


def _order_cols(side: Side, order: Sequence[str]) -> list[str]:
    return [side.col(o) for o in order]


def dedup_by_key(df: DataFrame, side: Side, order: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per ``join_key``: fewest missing fields, then first in row order."""
    w = Window.partitionBy("join_key").orderBy(side.col("missing_count"), *_order_cols(side, order))
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def first_position(side: Side, order: Sequence[str]) -> Column:
    cols = _order_cols(side, order)
    return F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)


def key_table(df: DataFrame, side: Side, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per ``join_key``: rows (``key_rows``), first position (``key_first``), district of the first row (``key_aun``)."""
    pos = first_position(side, order)
    return df.groupBy("join_key").agg(
        F.count(F.lit(1)).alias("key_rows"), F.min(pos).alias("key_first"), F.min_by(side.col("aun9_3"), pos).alias("key_aun"))


def duplicate_flags(df: DataFrame, side: Side, order: Sequence[str] = ("seq",), keys: DataFrame | None = None) -> DataFrame:
    """Adds ``is_duplicate``: TRUE for every row of a key after its first in row order.

    ``keys``: the side's ``key_table``, written once, so that a hot key can be split.
    """
    firsts = (key_table(df, side, order) if keys is None else keys).select("join_key", F.col("key_first").alias("_first"))
    return (
        df.join(firsts, "join_key")
        .withColumn("is_duplicate", first_position(side, order) != F.col("_first"))
        .drop("_first")
    )


def keyed(df: DataFrame, side: Side, policy: str = "name_dob") -> DataFrame:
    """Cleaned roster -> keys + missing count."""
    return with_missing_count(with_match_key(df, side, policy), side)
