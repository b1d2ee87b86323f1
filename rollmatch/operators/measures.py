"""District measures over the matched and per-side rosters.

One pass over the match
-----------------------
Every measure on matched students (eligibility counts, site code, guardian name,
address and case number mismatches, matched count) groups the same rows by the
same column, so ``match_measure_table`` computes all of them in one
``groupBy`` of conditional counts: one shuffle of the slim match instead of
seven. Each report then reads its columns from that table (Catalyst prunes the
aggregates a report does not use, including the Jaro UDF).

Raw (many-to-many) matching without pairs
-----------------------------------------
On raw rows a key repeated on both sides forms every pair of its rows. The
measures only need *counts* of pairs, so ``pair_measure_table`` counts them
from per-key aggregates: pairs = rows_S x rows_P, "differs" = non-missing pairs
minus equal pairs, and equal pairs come from an equi-join of per-(key, value)
counts. Every shuffle carries aggregates; no pair is ever emitted. The address
measure needs a similarity per pair and is built on the de-duplicated match only.

Per-district reports follow the original layout: the district id without dashes
(``AUN``), the measure, then the district name and school type from the dimension;
ids become numbers where the original converts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.address import standardize_address
from rollmatch.functions.aun import plain_aun, valid_aun
from rollmatch.functions.jaro import decided_below, jaro_below, jaro_similarity
from rollmatch.functions.nulls import count_where, distinct_with_null, strict_sum
from rollmatch.functions.text import decodable_or_null, present, trim_ws
from rollmatch.operators.dimension import enrich
from rollmatch.operators.keys import SECURE_ID_LENGTH, first_position
from rollmatch.schema import Side

# The eligibility values counted, in output order.
ELIGIBILITY_VALUES = ("free", "paid", "reduced")
# Address similarity below this counts as a mismatch.
ADDRESS_THRESHOLD = 0.9

MISMATCH_MEASURES = (
    "school_code_mismatch_count",
    "parent_name_mismatch_count",
    "address_mismatch_count",
    "case_number_mismatch_count",
)


# ---------------------------------------------------------------- conditions

def _elig(side: Side) -> Column:
    return F.lower(F.col(side.col("eligibility")))


def _norm(c: str) -> Column:
    return F.lower(trim_ws(F.col(c)))


def site_code_differs(s: Side, p: Side) -> Column:
    a, b = F.col(s.col("school_code4")), F.col(p.col("school_code4"))
    return a.isNotNull() & b.isNotNull() & (a != b)


def case_number_differs(s: Side, p: Side) -> Column:
    a, b = F.col(s.col("case_number")), F.col(p.col("case_number"))
    return a.isNotNull() & b.isNotNull() & (a != b)


def _names_present(side: Side) -> Column:
    return F.col(side.col("parent_first_name")).isNotNull() & F.col(side.col("parent_last_name")).isNotNull()


def parent_name_differs(s: Side, p: Side, mode: str = "or") -> Column:
    """All four names present; trimmed lower-case first ``or`` (default) / ``and`` last differ."""
    first = _norm(s.col("parent_first_name")) != _norm(p.col("parent_first_name"))
    last = _norm(s.col("parent_last_name")) != _norm(p.col("parent_last_name"))
    both = _names_present(s) & _names_present(p)
    if mode == "or":
        return both & (first | last)
    if mode == "and":
        return both & first & last
    raise ValueError("mode must be 'or' or 'and'")


def address_text(side: Side) -> Column:
    """The side's first address line, standardized; NULL if undecodable, missing or blank."""
    a = decodable_or_null(F.col(side.col("student_address1")))
    return F.when(present(a), standardize_address(a))


_A, _B, _N = "_addr_s", "_addr_p", "_n"


def with_address_texts(match: DataFrame, s: Side, p: Side) -> DataFrame:
    """Both standardized address texts as columns, so that no comparison repeats the rewriting."""
    return match.withColumns({_A: address_text(s), _B: address_text(p)})


def address_differs(threshold: float = ADDRESS_THRESHOLD, transpositions: str = "half", prefix_weight: float = 0.0) -> Column:
    """On rows of ``with_address_texts``: both texts there and Jaro < threshold."""
    return F.coalesce(jaro_below(_A, _B, threshold, transpositions, prefix_weight), F.lit(False))


def address_mismatch_counts(match: DataFrame, s: Side, p: Side, district: Column, name: str,
                            threshold: float = ADDRESS_THRESHOLD, transpositions: str = "half",
                            prefix_weight: float = 0.0) -> DataFrame:
    """Per ``district`` (as ``name``): matched rows whose standardized addresses differ (Jaro < threshold).

    Each text is standardized once; equal pairs and pairs too unlike in length are settled in
    the JVM. The others are counted per distinct pair first, so Python scores a pair once and
    sees undecided pairs only.
    """
    pairs = (match.select(district.alias(name), address_text(s).alias(_A), address_text(p).alias(_B))
             .filter(F.col(_A).isNotNull() & F.col(_B).isNotNull() & (F.col(_A) != F.col(_B)))
             .groupBy(name, _A, _B).agg(F.count(F.lit(1)).alias(_N)))
    decided = decided_below(_A, _B, threshold, prefix_weight)
    sure = pairs.filter(decided).select(name, _N)
    open_pairs = pairs.filter(decided.isNull())
    scored = open_pairs.filter(jaro_similarity(_A, _B, transpositions, prefix_weight) < F.lit(threshold)).select(name, _N)
    return sure.union(scored).groupBy(name).agg(F.sum(_N).alias("address_mismatch_count"))


def address_similarity(s: Side, p: Side, transpositions: str = "half") -> Column:
    """Similarity of the standardized address texts; NULL where one side has none."""
    return jaro_similarity(address_text(s), address_text(p), transpositions)


# ---------------------------------------------------------------- one pass over the 1:1 match

def match_measure_table(match: DataFrame, s: Side, p: Side, parent_mode: str = "or",
                        threshold: float = ADDRESS_THRESHOLD, transpositions: str = "half",
                        prefix_weight: float = 0.0, address: bool = True) -> DataFrame:
    """All matched-student measures per S-side district text: one aggregation, and with ``address``
    the address counts (``address_mismatch_counts``) joined to it."""
    a = s.col("aun9_3")
    aggs = [F.count(F.lit(1)).alias("matched")]
    aggs += [count_where(_elig(s) == v).alias(s.col(v)) for v in ELIGIBILITY_VALUES]
    aggs += [count_where(_elig(p) == v).alias(p.col(v)) for v in ELIGIBILITY_VALUES]
    aggs += [
        count_where(site_code_differs(s, p)).alias("school_code_mismatch_count"),
        count_where(parent_name_differs(s, p, parent_mode)).alias("parent_name_mismatch_count"),
        count_where(case_number_differs(s, p)).alias("case_number_mismatch_count"),
    ]
    counted = match.groupBy(a).agg(*aggs)
    if not address:
        return counted
    differ = address_mismatch_counts(match, s, p, F.col(a), "_aun", threshold, transpositions, prefix_weight)
    out = counted.join(differ, counted[a].eqNullSafe(differ["_aun"]), "left").drop("_aun")
    return out.withColumn("address_mismatch_count", F.coalesce("address_mismatch_count", F.lit(0)))


# ---------------------------------------------------------------- raw pairs, counted not emitted

#: Pair measure -> the kinds of value it compares between the sides.
PAIR_MEASURES = {
    "matched": (), "eligibility": (),
    "school_code_mismatch_count": ("code",), "case_number_mismatch_count": ("case",), "parent_name_mismatch_count": ("names",),
}


def _compared_values(side: Side, kinds: Sequence[str]) -> list[Column]:
    """Per row, one (kind, value) record for each value the wanted measures compare."""
    code, case = F.col(side.col("school_code4")), F.col(side.col("case_number"))
    first, last = _norm(side.col("parent_first_name")), _norm(side.col("parent_last_name"))
    names_ok = _names_present(side)

    def rec(kind: str, here: Column, value: Column) -> Column:
        return F.when(here, F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value")))

    records = {
        "code": rec("code", code.isNotNull(), code), "case": rec("case", case.isNotNull(), case),
        "names": rec("names", names_ok, F.to_json(F.array(first, last))),
        "first": rec("first", names_ok, first), "last": rec("last", names_ok, last),
    }
    return [records[k] for k in kinds]


def _value_counts(rows: DataFrame, side: Side, keys: list[str], kinds: Sequence[str], out: str) -> DataFrame:
    r = F.explode(F.array(*_compared_values(side, kinds))).alias("_r")
    here = F.col("_r").isNotNull() & F.col("_r.kind").isNotNull() & F.col("_r.value").isNotNull()
    return (rows.select(*keys, r).filter(here)
            .groupBy(*keys, F.col("_r.kind").alias("kind"), F.col("_r.value").alias("value"))
            .agg(F.count(F.lit(1)).alias(out)))


def _key_totals(rows: DataFrame, side: Side, keys: list[str], wanted: Sequence[str], tag: str) -> DataFrame:
    """Per key: the row counts that the wanted measures multiply."""
    elig = _elig(side)
    counts = {
        "matched": [F.count(F.lit(1)).alias(f"_{tag}")],
        "eligibility": [F.count(F.lit(1)).alias(f"_{tag}"), *[count_where(elig == v).alias(f"_{tag}_{v}") for v in ELIGIBILITY_VALUES]],
        "school_code_mismatch_count": [F.count(side.col("school_code4")).alias(f"_{tag}_code")],
        "case_number_mismatch_count": [F.count(side.col("case_number")).alias(f"_{tag}_case")],
        "parent_name_mismatch_count": [count_where(_names_present(side)).alias(f"_{tag}_names")],
    }
    aggs = {str(c): c for w in wanted for c in counts[w]}
    return rows.groupBy(*keys).agg(*aggs.values())


def pair_measure_table(s_rows: DataFrame, p_rows: DataFrame, s: Side, p: Side, parent_mode: str = "or",
                       wanted: Sequence[str] = tuple(PAIR_MEASURES)) -> DataFrame:
    """``wanted`` matched-pair measures of the raw many-to-many match, per S-side district text.

    Same columns as ``match_measure_table`` except the address measure. Counts of rows per
    key (one shuffle per side, of aggregates) give pairs as products. Only measures that
    compare values also count rows per key and value, and only of the kinds they need;
    everything after that works on those counts. ``matched`` alone reads key and district.
    """
    if parent_mode not in ("or", "and"):
        raise ValueError("parent_mode must be 'or' or 'and'")
    sa = s.col("aun9_3")
    t = (_key_totals(s_rows, s, ["join_key", sa], wanted, "ns")
         .join(_key_totals(p_rows, p, ["join_key"], wanted, "np"), "join_key"))
    kinds = [k for w in wanted for k in PAIR_MEASURES[w]]
    kinds += ["first", "last"] if "names" in kinds and parent_mode == "and" else []
    if kinds:
        sc = _value_counts(s_rows, s, ["join_key", sa], kinds, "_sv")
        pc = _value_counts(p_rows, p, ["join_key"], kinds, "_pv")
        eq = (sc.join(pc, ["join_key", "kind", "value"]).groupBy("join_key", sa)
              .agg(*[F.sum(F.when(F.col("kind") == k, F.col("_sv") * F.col("_pv"))).alias(f"_{k}_eq") for k in kinds]))
        t = t.join(eq, ["join_key", sa], "left")

    def differ(kind: str) -> Column:
        pairs = F.col(f"_ns_{kind}") * F.col(f"_np_{kind}")
        equal = lambda k: F.coalesce(F.col(f"_{k}_eq"), F.lit(0))
        if kind == "names" and parent_mode == "and":
            return pairs - equal("first") - equal("last") + equal("names")
        return pairs - equal(kind)

    per_key = {
        "matched": [(F.col("_ns") * F.col("_np")).alias("matched")] if "matched" in wanted else [],
        "eligibility": [*[(F.col("_ns_" + v) * F.col("_np")).alias(s.col(v)) for v in ELIGIBILITY_VALUES],
                        *[(F.col("_ns") * F.col("_np_" + v)).alias(p.col(v)) for v in ELIGIBILITY_VALUES]] if "eligibility" in wanted else [],
    }
    for w in wanted:
        if PAIR_MEASURES[w]:
            per_key[w] = [differ(PAIR_MEASURES[w][0]).alias(w)]
    columns = [c for w in PAIR_MEASURES if w in wanted for c in per_key[w]]
    slim = t.select(sa, *columns)
    return slim.groupBy(sa).agg(*[F.sum(c).cast("long").alias(c) for c in slim.columns if c != sa])


# ---------------------------------------------------------------- reports from a measure table

def mismatch_report(table: DataFrame, measure: str, s: Side, dim: DataFrame) -> DataFrame:
    """Districts with at least one mismatch: ``AUN`` (number), count, district name, type."""
    out = (table.filter(F.col(measure) > 0)
           .select(plain_aun(s.col("aun9_3")).alias("AUN"), F.col(measure)))
    return enrich(out, dim, numeric=True)


def matched_students(table: DataFrame, s: Side, dim: DataFrame) -> DataFrame:
    """Matched students per district (``n``)."""
    a = s.col("aun9_3")
    out = table.select(F.col(a), F.col("matched").alias("n"), plain_aun(a).alias("AUN"))
    return enrich(out, dim, numeric=True)


def eligibility_comparison(table: DataFrame, s: Side, p: Side, dim: DataFrame) -> DataFrame:
    """Counts of free / paid / reduced on both sides of the match and S - P differences.

    A side lists a district only when it has a counted value there, so its three
    counts are NULL otherwise and so are the differences.
    """
    s_any = sum((F.col(s.col(v)) for v in ELIGIBILITY_VALUES), F.lit(0))
    p_any = sum((F.col(p.col(v)) for v in ELIGIBILITY_VALUES), F.lit(0))
    cols = [plain_aun(s.col("aun9_3")).alias("AUN")]
    cols += [F.when(s_any > 0, F.col(s.col(v))).alias(s.col(v)) for v in ELIGIBILITY_VALUES]
    cols += [F.when(p_any > 0, F.col(p.col(v))).alias(p.col(v)) for v in ELIGIBILITY_VALUES]
    out = table.filter((s_any > 0) | (p_any > 0)).select(*cols)
    out = out.select("*", *[(F.col(s.col(v)) - F.col(p.col(v))).alias("diff_" + v) for v in ELIGIBILITY_VALUES])
    return enrich(out, dim, numeric=True)


# ---------------------------------------------------------------- per-side measures

def side_counts(rows: DataFrame, side: Side, out: str = "n") -> DataFrame:
    return rows.groupBy(side.col("aun9_3")).agg(F.count(F.lit(1)).alias(out))


def student_counts(rows: DataFrame, side: Side, dim: DataFrame) -> DataFrame:
    """Students per district on one side (de-duplicated rows by default upstream)."""
    a = side.col("aun9_3")
    out = side_counts(rows, side).withColumn("AUN", plain_aun(a))
    return enrich(out, dim, numeric=True)


def student_count_comparison(p_rows: DataFrame, s_rows: DataFrame, p: Side, s: Side,
                             dim: DataFrame) -> DataFrame:
    """Per district: rows on each side (absent side = 0) and the difference P - S."""
    pc = side_counts(p_rows, p, p.col("total"))
    sc = side_counts(s_rows, s, s.col("total"))
    j = pc.join(sc, pc[p.col("aun9_3")].eqNullSafe(sc[s.col("aun9_3")]), "full")
    pt = F.coalesce(F.col(p.col("total")), F.lit(0))
    st = F.coalesce(F.col(s.col("total")), F.lit(0))
    out = j.select(
        plain_aun(F.coalesce(F.col(p.col("aun9_3")), F.col(s.col("aun9_3")))).alias("AUN"),
        st.alias(s.col("total")), pt.alias(p.col("total")), (pt - st).alias("difference"),
    )
    out = enrich(out, dim, numeric=True).drop("schl_type")
    return out


def ids_len10(rows: DataFrame, side: Side) -> DataFrame:
    """Per district: secure ids of exactly 10 characters; NULL if any id is missing."""
    sid = F.col(side.col("pasecureid"))
    flag = F.when(sid.isNull(), F.lit(None)).when(F.length(sid) == SECURE_ID_LENGTH, F.lit(1)).otherwise(F.lit(0))
    return rows.groupBy(side.col("aun9_3")).agg(strict_sum(flag).alias(side.col("ids_len10")))


def id_length_counts(s_rows: DataFrame, p_rows: DataFrame, s: Side, p: Side, dim: DataFrame) -> DataFrame:
    """10-character secure ids per S district on both sides (P-only districts drop)."""
    sc, pc = ids_len10(s_rows, s), ids_len10(p_rows, p)
    j = sc.join(pc, sc[s.col("aun9_3")].eqNullSafe(pc[p.col("aun9_3")]), "left")
    out = j.select(plain_aun(F.col(s.col("aun9_3"))).alias("AUN"), s.col("ids_len10"), p.col("ids_len10"))
    return enrich(out, dim, numeric=True)


def repeated_students(rows: DataFrame, side: Side, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per district: keys on more than one row, and the number of keys."""
    per_key = rows.groupBy("join_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(side.col("aun9_3"), first_position(side, order)).alias("_aun"),
    )
    out = (per_key.groupBy(plain_aun("_aun").alias("AUN"))
           .agg(count_where(F.col("n") > 1).alias("num_duplicated_join_keys"),
                F.count(F.lit(1)).alias("numsts")))
    return out


def districts_per_key(rows: DataFrame, side: Side, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per key: rows, distinct districts (NULL counted), first district in row order."""
    a = side.col("aun9_3")
    return rows.groupBy("join_key").agg(
        F.count(F.lit(1)).alias("n"),
        distinct_with_null(a).alias("auns_per_student"),
        F.min_by(a, first_position(side, order)).alias(a),
    )


def repeated_secure_ids(rows: DataFrame, side: Side, dim: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """Per secure id: first district in row order and 1 when the id is on several rows."""
    a = side.col("aun9_3")
    out = rows.groupBy(side.col("pasecureid")).agg(
        F.min_by(a, first_position(side, order)).alias(a),
        (F.count(F.lit(1)) > 1).cast("int").alias("num_duplicated_join_keys"),
    ).withColumn("AUN", plain_aun(a))
    return enrich(out, dim)


def duplicate_profile(df: DataFrame, col: str, label: str) -> DataFrame:
    """How many values repeat an earlier one: rows (FALSE, n, share) and (TRUE, n, share)."""
    stats = df.agg(F.count(F.lit(1)).alias("_total"), distinct_with_null(col).alias("_distinct"))
    return _profile_rows(stats, label)


def _profile_rows(stats: DataFrame, label: str) -> DataFrame:
    dup = F.col("_total") - F.col("_distinct")
    rows = F.explode(F.array(
        F.struct(F.lit(False).alias("is_duplicated"), F.col("_distinct").alias("n")),
        F.struct(F.lit(True).alias("is_duplicated"), dup.alias("n")),
    ))
    return stats.select(F.lit(label).alias("measure"), F.col("_total"), rows.alias("r")).select(
        "measure", "r.is_duplicated", "r.n", (F.col("r.n") / F.col("_total")).alias("percent"))


def matched_id_profile(rows: DataFrame, other: DataFrame, side: Side, label: str) -> DataFrame:
    """The duplicate profile of this side's secure ids over the raw many-to-many match, from counts:
    a row stands in as many pairs as its key has rows on the other side."""
    sid = side.col("pasecureid")
    per_id = (rows.groupBy("join_key", sid).agg(F.count(F.lit(1)).alias("_n"))
              .join(other.groupBy("join_key").agg(F.count(F.lit(1)).alias("_m")), "join_key")
              .groupBy(sid).agg(F.sum(F.col("_n") * F.col("_m")).alias("_pairs")))
    stats = per_id.agg(F.coalesce(F.sum("_pairs"), F.lit(0)).alias("_total"), F.count(F.lit(1)).alias("_distinct"))
    return _profile_rows(stats, label)


def district_count(rows: DataFrame, side: Side) -> DataFrame:
    """Number of distinct district ids (NULL counted as one)."""
    return rows.agg(distinct_with_null(side.col("aun9_3")).alias("n_districts"))


def invalid_district_ids(rows: DataFrame, side: Side) -> DataFrame:
    """Distinct district ids that are not well-formed dashed ids."""
    a = side.col("aun9_3")
    return rows.select(a).distinct().filter(~valid_aun(a))


def invalid_district_count(rows: DataFrame, side: Side) -> DataFrame:
    """How many distinct district ids are not well-formed."""
    return invalid_district_ids(rows, side).agg(F.count(F.lit(1)).alias("n_invalid"))


def _running_total_ranged(counts: DataFrame, col: str, parts: int) -> DataFrame:
    """``col``, ``n``, running total ``_cum`` and grand total ``_total`` without a one-task window.

    Rows are range-partitioned and sorted; each range computes its local running sum
    (``mapInPandas``) and tags its rows with the range's first value. The ranges are
    checkpointed, so both uses below see the same rows; the per-range totals (one row
    per range, at most ``parts``) give each range its offset and the grand total.
    """
    import pandas as pd

    from rollmatch.session import cut_lineage

    ordered = (counts.repartitionByRange(parts, F.col(col).asc_nulls_last())
               .sortWithinPartitions(F.col(col).asc_nulls_last()))
    schema = counts.schema.add("_first", counts.schema[col].dataType).add("_local", "long")

    def local_sums(batches):
        first, started, total = None, False, 0
        for pdf in batches:
            if pdf.empty:
                continue
            if not started:
                first, started = pdf[col].iloc[0], True
            cum = pdf["n"].cumsum() + total
            total = int(cum.iloc[-1])
            yield pdf.assign(_first=first, _local=cum.astype("int64"))
        if not started:
            yield pd.DataFrame({c: pd.Series(dtype="object") for c in schema.fieldNames()})

    local = cut_lineage(ordered.mapInPandas(local_sums, schema))
    first = F.col("_first")
    totals = local.groupBy("_first").agg(F.max("_local").alias("_range_total"))
    before = Window.orderBy(first.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        first.alias("_f"),
        F.coalesce(F.sum("_range_total").over(before), F.lit(0)).alias("_off"),
        F.sum("_range_total").over(Window.partitionBy()).alias("_total"),
    )
    joined = local.join(F.broadcast(offsets), local["_first"].eqNullSafe(offsets["_f"]))
    return joined.select(col, "n", (F.col("_local") + F.col("_off")).alias("_cum"), "_total")


def frequency_table(df: DataFrame, col: str) -> DataFrame:
    """Count, share and cumulative share per value (values ascending, NULL last).

    Works on the aggregated table (one row per distinct value), range-partitioned by value
    (``_running_total_ranged``), so no task ever holds the whole table.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    cum = _running_total_ranged(counts, col, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cum.select(
        F.col(col).alias("value"), "n",
        (F.col("n") / F.col("_total")).alias("percent"),
        (F.col("_cum") / F.col("_total")).alias("cum_percent"),
    )


def frequency_report(df: DataFrame, col: str) -> DataFrame:
    """Frequency table with a total and a missing row: (kind, value, n, valid_percent, percent, cum_percent).

    ``kind`` is ``value``, ``total`` (of the values there) or ``missing`` (NULL); both of these rows always stand.
    Valid and cumulative shares are of the values there, ``percent`` is of all rows; shares of nothing are NULL.
    Like ``frequency_table`` it counts once and sums ranges; only two totals meet in one task.
    """
    spark = df.sparkSession
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    valid = F.coalesce(F.sum(F.when(F.col(col).isNotNull(), F.col("n"))), F.lit(0))
    sums = counts.agg(valid.alias("_valid"), F.coalesce(F.sum("n"), F.lit(0)).alias("_all"))
    cum = _running_total_ranged(counts.filter(F.col(col).isNotNull()), col, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = sums.select("_all").scalar()
    values = cum.select(F.lit("value").alias("kind"), F.col(col).alias("value"), "n", F.try_divide("n", "_total").alias("valid_percent"),
                        F.try_divide(F.col("n"), rows).alias("percent"), F.try_divide("_cum", "_total").alias("cum_percent"))
    nothing = F.lit(None).cast("double")
    total = sums.select(F.lit("total"), F.lit(None).cast(df.schema[col].dataType), "_valid", F.try_divide("_valid", "_valid"),
                        F.try_divide("_valid", "_all"), F.try_divide("_valid", "_valid"))
    missing = sums.select(F.lit("missing"), F.lit(None).cast(df.schema[col].dataType), F.col("_all") - F.col("_valid"), nothing,
                          F.try_divide(F.col("_all") - F.col("_valid"), F.col("_all")), nothing)
    return values.union(total).union(missing)


def crosstab_row_percent(df: DataFrame, row_col: str, flag_col: str, values: Sequence = (0, 1)) -> DataFrame:
    """Counts of ``flag_col`` values per ``row_col`` value, with row shares."""
    counts = df.groupBy(row_col).agg(
        *[count_where(F.col(flag_col) == F.lit(v)).alias(f"n_{v}") for v in values],
        F.count(F.lit(1)).alias("_row_total"))
    return counts.select(
        row_col, *[f"n_{v}" for v in values],
        *[(F.col(f"n_{v}") / F.col("_row_total")).alias(f"pct_{v}") for v in values])


def address_value_missing(table: DataFrame, s: Side, dim: DataFrame, key: str = "aun_2") -> DataFrame:
    """Every district of the dimension with ``missing_address_count`` = 1 where the address mismatch
    report has no row for it, else 0."""
    reported = (table.groupBy(plain_aun(s.col("aun9_3")).alias("_aun")).agg(F.sum("address_mismatch_count").alias("_n"))
                .filter(F.col("_n") > 0))
    out = dim.join(reported, dim[key] == reported["_aun"], "left")
    return out.withColumn("missing_address_count", F.col("_n").isNull().cast("int")).drop("_aun", "_n")


def difference_histogram(df: DataFrame, a: str, b: str, width: int) -> DataFrame:
    """Fixed-width bucket counts of ``a - b`` (rows with a NULL difference drop)."""
    d = F.col(a) - F.col(b)
    lo = F.floor(d / F.lit(width)) * F.lit(width)
    return (df.filter(d.isNotNull()).groupBy(lo.cast("long").alias("bucket_start"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bucket_end", F.col("bucket_start") + F.lit(width)))


def head_tail(df: DataFrame, order_col: str, n: int = 6) -> DataFrame:
    """First and last ``n`` rows by ``order_col`` (a top-k report on both ends)."""
    head = df.orderBy(F.col(order_col).asc_nulls_last()).limit(n).withColumn("position", F.lit("head"))
    tail = df.orderBy(F.col(order_col).desc_nulls_first()).limit(n).withColumn("position", F.lit("tail"))
    return head.unionByName(tail)
