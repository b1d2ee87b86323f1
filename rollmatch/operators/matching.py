"""Matching the two rosters on ``join_key``.

All joins are equi-joins. Semi/anti joins always run against the *distinct* keys
of the other side, so a key repeated on the other side never makes the join
buffer its rows; given as a written ``key_table`` they also let AQE split a hot key
of the rows. The many-to-many match of raw rows is never materialized: a
key that holds a third of the rows on both sides would emit (n/3)^2 pairs.
Instead ``pair_counts`` gives per-key row counts and their product, and the
measures on raw rows (``operators.measures.pair_measure_table``) count pairs
from per-key aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.text import present
from rollmatch.schema import Side


def match_one_to_one(left_undup: DataFrame, right_undup: DataFrame) -> DataFrame:
    """Inner join of two de-duplicated sides on ``join_key`` (one row per key each)."""
    return left_undup.join(right_undup, "join_key", "inner")


def _keys(df: DataFrame) -> DataFrame:
    return df.select("join_key").distinct()


def unmatched(rows: DataFrame, other: DataFrame, other_keys: DataFrame | None = None) -> DataFrame:
    """Rows (all columns) whose ``join_key`` never occurs on the other side.

    ``other_keys``: the other side's ``key_table``, written once (one row per key).
    """
    keys = _keys(other) if other_keys is None else other_keys.select("join_key")
    return rows.join(keys, "join_key", "left_anti")


def matched_rows(rows: DataFrame, other: DataFrame, other_keys: DataFrame | None = None) -> DataFrame:
    """Rows whose ``join_key`` occurs on the other side (complement of ``unmatched``)."""
    keys = _keys(other) if other_keys is None else other_keys.select("join_key")
    return rows.join(keys, "join_key", "left_semi")


def key_counts(df: DataFrame, out: str = "n") -> DataFrame:
    """Rows per ``join_key`` (map-side combined)."""
    return df.groupBy("join_key").agg(F.count(F.lit(1)).alias(out))


def pair_counts(left: DataFrame, right: DataFrame, left_side: Side, right_side: Side) -> DataFrame:
    """Per key on both sides: rows on each side and the number of raw pairs they form."""
    lc = key_counts(left, left_side.col("rows"))
    rc = key_counts(right, right_side.col("rows"))
    return lc.join(rc, "join_key").withColumn(
        "pairs", F.col(left_side.col("rows")) * F.col(right_side.col("rows")))


def keys_duplicated_both_sides(left: DataFrame, right: DataFrame, left_side: Side, right_side: Side) -> DataFrame:
    """Keys on more than one row on *both* sides, with both row counts."""
    lc = key_counts(left, left_side.col("rows")).filter(F.col(left_side.col("rows")) > 1)
    rc = key_counts(right, right_side.col("rows")).filter(F.col(right_side.col("rows")) > 1)
    return lc.join(rc, "join_key")


# Output names of the unmatched-id list.
ID_LIST_COLUMNS = ("AUN", "PAsecureID", "FirstName", "LastName")


def id_list(df: DataFrame, side: Side) -> DataFrame:
    """Distinct (district, secure id, first, last) with both ids present."""
    c = side.col
    src = (c("aun9_3"), c("pasecureid"), c("student_first_name"), c("student_last_name"))
    return (
        df.filter(present(c("pasecureid")) & present(c("aun9_3")))
        .select([F.col(s).alias(t) for s, t in zip(src, ID_LIST_COLUMNS)])
        .distinct()
    )


def unmatched_ids(left: DataFrame, right: DataFrame, left_side: Side, right_side: Side) -> DataFrame:
    """Ids present on one side only, compared within district, labelled by source."""
    on = list(ID_LIST_COLUMNS[:2])
    lids, rids = id_list(left, left_side), id_list(right, right_side)
    only_left = lids.join(rids.select(on).distinct(), on, "left_anti").withColumn("Source", F.lit(left_side.name))
    only_right = rids.join(lids.select(on).distinct(), on, "left_anti").withColumn("Source", F.lit(right_side.name))
    return only_left.unionByName(only_right)
