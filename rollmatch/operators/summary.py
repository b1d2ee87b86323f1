"""Combined per-district summary: every measure on one plain district id, in one pass.

The two de-duplicated sides are full-outer-joined on ``join_key`` (both are already
hash-partitioned on it by the de-duplication, so the join adds no exchange). Each
joined row then contributes one record to its S district (the S row, and the match
measures when both sides are present) and one to its P district (the P row). One
aggregation by plain district id sums everything: each side is de-duplicated once,
and the only other shuffle carries partial sums per district.

Dashed and undashed forms of one district fold into its plain id. Measures are
filled with 0, the key is not; the dimension is joined once at the end. A side's
eligibility counts are NULL (then 0) when it has no counted value in the district,
and so are the differences, as in the per-measure report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.aun import plain_aun
from rollmatch.operators.dimension import enrich
from rollmatch.operators.keys import SECURE_ID_LENGTH
from rollmatch.operators.measures import (
    ADDRESS_THRESHOLD,
    ELIGIBILITY_VALUES,
    MISMATCH_MEASURES,
    _elig,
    address_differs,
    case_number_differs,
    parent_name_differs,
    site_code_differs,
    with_address_texts,
)
from rollmatch.schema import Side


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _id_flags(side: Side) -> tuple[Column, Column]:
    sid = F.col(side.col("pasecureid"))
    return _flag(F.length(sid) == SECURE_ID_LENGTH), _flag(sid.isNull())


def district_summary(s_undup: DataFrame, p_undup: DataFrame, s: Side, p: Side, dim: DataFrame,
                     parent_mode: str = "or", threshold: float = ADDRESS_THRESHOLD,
                     transpositions: str = "half", prefix_weight: float = 0.0) -> DataFrame:
    j = with_address_texts(s_undup.join(p_undup, "join_key", "full"), s, p)
    s_here = F.col(s.col("aun9_3")).isNotNull()
    p_here = F.col(p.col("aun9_3")).isNotNull()
    matched = s_here & p_here
    zero = F.lit(0)

    counted = [s.col(v) for v in ELIGIBILITY_VALUES] + [p.col(v) for v in ELIGIBILITY_VALUES]
    measure_names = ["matched", *counted, *MISMATCH_MEASURES]
    side_names = [s.col("total"), s.col("ids_len10"), s.col("_id_null"),
                  p.col("total"), p.col("ids_len10"), p.col("_id_null")]
    s_len, s_null = _id_flags(s)
    p_len, p_null = _id_flags(p)
    match_vals = {
        "matched": _flag(matched),
        **{s.col(v): _flag(matched & (_elig(s) == v)) for v in ELIGIBILITY_VALUES},
        **{p.col(v): _flag(matched & (_elig(p) == v)) for v in ELIGIBILITY_VALUES},
        "school_code_mismatch_count": _flag(matched & site_code_differs(s, p)),
        "parent_name_mismatch_count": _flag(matched & parent_name_differs(s, p, parent_mode)),
        "address_mismatch_count": _flag(matched & address_differs(threshold, transpositions, prefix_weight)),
        "case_number_mismatch_count": _flag(matched & case_number_differs(s, p)),
    }
    s_rec = F.struct(
        plain_aun(s.col("aun9_3")).alias("AUN"),
        F.lit(1).alias(s.col("total")), s_len.alias(s.col("ids_len10")), s_null.alias(s.col("_id_null")),
        zero.alias(p.col("total")), zero.alias(p.col("ids_len10")), zero.alias(p.col("_id_null")),
        *[match_vals[m].alias(m) for m in measure_names],
    )
    p_rec = F.struct(
        plain_aun(p.col("aun9_3")).alias("AUN"),
        zero.alias(s.col("total")), zero.alias(s.col("ids_len10")), zero.alias(s.col("_id_null")),
        F.lit(1).alias(p.col("total")), p_len.alias(p.col("ids_len10")), p_null.alias(p.col("_id_null")),
        *[zero.alias(m) for m in measure_names],
    )
    recs = j.select(F.explode(F.array(F.when(s_here, s_rec), F.when(p_here, p_rec))).alias("r"))
    per = recs.filter(F.col("r").isNotNull()).select("r.*")

    sums = per.groupBy("AUN").agg(
        *[F.sum(c).alias(c) for c in side_names if not c.endswith("_id_null")],
        *[F.max(c).alias(c) for c in side_names if c.endswith("_id_null")],
        *[F.sum(c).alias(c) for c in measure_names],
    )

    def z(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long")

    s_any = sum((F.col(c) for c in counted[:3]), F.lit(0))
    p_any = sum((F.col(c) for c in counted[3:]), F.lit(0))
    elig = {c: F.when((s_any if c.startswith(s.prefix) else p_any) > 0, F.col(c)) for c in counted}
    out = sums.select(
        "AUN",
        z(F.col(s.col("total"))).alias(s.col("total")),
        z(F.when(F.col(s.col("_id_null")) == 0, F.col(s.col("ids_len10")))).alias(s.col("ids_len10")),
        z(F.col(p.col("total"))).alias(p.col("total")),
        z(F.when(F.col(p.col("_id_null")) == 0, F.col(p.col("ids_len10")))).alias(p.col("ids_len10")),
        *[z(elig[c]).alias(c) for c in counted],
        *[z(F.col(m)).alias(m) for m in ["matched", *MISMATCH_MEASURES]],
        *[z(elig[s.col(v)] - elig[p.col(v)]).alias("diff_" + v) for v in ELIGIBILITY_VALUES],
    )
    return enrich(out, dim)


def district_summary_raw(s_rows: DataFrame, p_rows: DataFrame, pair_table: DataFrame, s: Side, p: Side,
                         dim: DataFrame) -> DataFrame:
    """The summary over raw rows and the raw many-to-many match (counted from aggregates by
    ``measures.pair_measure_table``; no address measure). Three per-district tables, each
    already one row per plain district id, joined on that id."""
    def side_part(rows: DataFrame, side: Side) -> DataFrame:
        sid_len, sid_null = _id_flags(side)
        return rows.groupBy(plain_aun(side.col("aun9_3")).alias("AUN")).agg(
            F.count(F.lit(1)).alias(side.col("total")),
            F.sum(sid_len).alias(side.col("ids_len10")),
            F.max(sid_null).alias(side.col("_id_null")),
        )

    counted = [s.col(v) for v in ELIGIBILITY_VALUES] + [p.col(v) for v in ELIGIBILITY_VALUES]
    measures = [m for m in ("matched", *MISMATCH_MEASURES) if m in pair_table.columns]
    pairs = pair_table.groupBy(plain_aun(s.col("aun9_3")).alias("AUN")).agg(
        *[F.sum(c).alias(c) for c in counted + measures])
    joined = side_part(s_rows, s).join(side_part(p_rows, p), "AUN", "full").join(pairs, "AUN", "full")

    def z(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long")

    s_any = sum((F.col(c) for c in counted[:3]), F.lit(0))
    p_any = sum((F.col(c) for c in counted[3:]), F.lit(0))
    elig = {c: F.when((s_any if c.startswith(s.prefix) else p_any) > 0, F.col(c)) for c in counted}
    out = joined.select(
        "AUN",
        z(F.col(s.col("total"))).alias(s.col("total")),
        z(F.when(F.col(s.col("_id_null")) == 0, F.col(s.col("ids_len10")))).alias(s.col("ids_len10")),
        z(F.col(p.col("total"))).alias(p.col("total")),
        z(F.when(F.col(p.col("_id_null")) == 0, F.col(p.col("ids_len10")))).alias(p.col("ids_len10")),
        *[z(elig[c]).alias(c) for c in counted],
        *[z(F.col(m)).alias(m) for m in measures],
        *[z(elig[s.col(v)] - elig[p.col(v)]).alias("diff_" + v) for v in ELIGIBILITY_VALUES],
    )
    return enrich(out, dim)
