"""Registered queries: one per operator family, on rosters derived from the supplied tables.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
tables. S = student upload (prefix ``s_``), P = meal system (prefix ``p_``).
The DuckDB oracle for each lives in ``rollmatch.plans.catalog_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.address import standardize_address
from rollmatch.functions.aun import (
    MEAL_FILE_AUN,
    UPLOAD_FILE_AUN,
    aun_from_filename,
    format_aun,
    numeric_aun,
    plain_aun,
)
from rollmatch.operators import measures as M
from rollmatch.operators.cleaning import districts_in, find_district, prepare_side, valid_district_rows
from rollmatch.operators.dimension import prepare_dimension
from rollmatch.operators.keys import dedup_by_key, duplicate_flags, with_match_key
from rollmatch.operators.matching import (
    id_list,
    keys_duplicated_both_sides,
    pair_counts,
    unmatched,
    unmatched_ids,
)
from rollmatch.plans.consolidate import consolidate_folder, consolidate_rosters
from rollmatch.plans.intake import combine_batches, intake_batch
from rollmatch.plans.reconcile import Reconciliation, keyed_side, reconcile
from rollmatch.schema import INTAKE_NAMES, MEAL, STUDENT
from rollmatch.sources import fixtures
from rollmatch.sources.csv import ORDER, folder_report, scan_rosters
from rollmatch.sources.districts import load_districts
from rollmatch.sources.export import write_named_csv
from rollmatch.sources.snapshot import snapshot_path, write_snapshot
from rollmatch.streaming.intake import start_intake_stream

S, P = STUDENT, MEAL

# The district-name fragment and id list used by the lookup queries.
LOOKUP_NAME_FRAGMENT = "NATION_1"
LOOKUP_IDS = (101010071.0, 102020142.0, 103030213.0)
# Histogram bucket width, head/tail length.
HISTOGRAM_WIDTH = 10
HEAD_TAIL_ROWS = 6
# The oracle (DuckDB's jaro_similarity) floors the transposition count.
ORACLE_TRANSPOSITIONS = "floor"


_PLANS: dict = {}


def _memo(spark: SparkSession, key: tuple, build):
    """Lazy plans are immutable: build each once per session and data folder."""
    k = (spark.sparkContext.applicationId, id(spark)) + key
    if k not in _PLANS:
        _PLANS[k] = build()
    return _PLANS[k]


def raw_rosters(spark: SparkSession, sf_dir: str):
    """Intake: derive both rosters from the tables once, snapshot them as Parquet in the
    shared checkpoint folder (as the original intake saves its batches), read them back."""
    def build():
        s_raw = write_snapshot(fixtures.student_roster(spark, sf_dir), snapshot_path(spark, sf_dir, "s_raw"))
        p_raw = write_snapshot(fixtures.meal_roster(spark, sf_dir), snapshot_path(spark, sf_dir, "p_raw"))
        return s_raw, p_raw, prepare_dimension(fixtures.district_dimension(spark, sf_dir))
    return _memo(spark, ("raw", sf_dir), build)


def keyed_rosters(spark: SparkSession, sf_dir: str, policy: str = "name_dob"):
    """Cleaned, keyed rows of both sides with their missing counts, snapshotted once per
    key policy: reports then read only the columns they use."""
    def build():
        s_raw, p_raw, _ = raw_rosters(spark, sf_dir)
        # map-only from the raw snapshot
        return tuple(
            write_snapshot(keyed_side(raw, side, policy), snapshot_path(spark, sf_dir, side.prefix + policy))
            for raw, side in ((s_raw, S), (p_raw, P)))
    return _memo(spark, ("keyed", sf_dir, policy), build)


def rec(spark: SparkSession, sf_dir: str, policy: str = "name_dob", **options) -> Reconciliation:
    def build():
        s_rows, p_rows = keyed_rosters(spark, sf_dir, policy)
        dim = raw_rosters(spark, sf_dir)[2]
        return reconcile(s_rows, p_rows, dim, policy, keyed=True, **options)
    return _memo(spark, ("rec", sf_dir, policy, tuple(sorted(options.items()))), build)


# ------------------------------------------------------------------ rows and keys

def clean_roster(spark, sf_dir):
    return prepare_side(raw_rosters(spark, sf_dir)[0], S)


def _keys(spark, sf_dir, policy):
    df = with_match_key(prepare_side(raw_rosters(spark, sf_dir)[0], S), S, policy)
    return df.select(S.col("seq"), S.col("join_key1"), S.col("join_key2"), "join_key")


def match_keys_name_dob(spark, sf_dir):
    return _keys(spark, sf_dir, "name_dob")


def match_keys_by_id_length(spark, sf_dir):
    return _keys(spark, sf_dir, "by_id_length")


def missing_counts(spark, sf_dir):
    return rec(spark, sf_dir).s_rows.select(S.col("seq"), "join_key", S.col("missing_count"))


def dedup_roster(spark, sf_dir):
    return rec(spark, sf_dir).s_undup


def dedup_roster_by_id_length(spark, sf_dir):
    return rec(spark, sf_dir, "by_id_length").p_undup


def duplicate_flags_q(spark, sf_dir):
    r = rec(spark, sf_dir)
    rows = r.s_rows.select(S.col("seq"), "join_key")
    return duplicate_flags(rows, S, keys=r.s_keys).select(S.col("seq"), "join_key", "is_duplicate")


def duplicate_profile(spark, sf_dir):
    r = rec(spark, sf_dir)
    parts = [
        M.duplicate_profile(r.s_rows, "join_key", "s_join_key"),
        M.duplicate_profile(r.p_rows, "join_key", "p_join_key"),
        M.duplicate_profile(r.match, "join_key", "match_join_key"),
        M.duplicate_profile(id_list(r.s_rows, S), "PAsecureID", "s_ids"),
        M.duplicate_profile(id_list(r.p_rows, P), "PAsecureID", "p_ids"),
        M.matched_id_profile(r.s_rows, r.p_rows, S, "match_s_pasecureid"),
        M.matched_id_profile(r.p_rows, r.s_rows, P, "match_p_pasecureid"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repeated_secure_ids(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.repeated_secure_ids(r.s_rows, S, r.dim)


# ------------------------------------------------------------------ matching

def match_one_to_one(spark, sf_dir):
    return rec(spark, sf_dir).match


def match_many_to_many(spark, sf_dir):
    r = rec(spark, sf_dir)
    return pair_counts(r.p_rows, r.s_rows, P, S)


def unmatched_left(spark, sf_dir):
    r = rec(spark, sf_dir)
    return unmatched(r.s_rows, r.p_rows, r.p_keys)


def unmatched_right(spark, sf_dir):
    r = rec(spark, sf_dir)
    return unmatched(r.p_rows, r.s_rows, r.s_keys)


def unmatched_ids_q(spark, sf_dir):
    r = rec(spark, sf_dir)
    return unmatched_ids(r.p_rows, r.s_rows, P, S)


def keys_duplicated_both_sides_q(spark, sf_dir):
    r = rec(spark, sf_dir)
    return keys_duplicated_both_sides(r.p_rows, r.s_rows, P, S)


# ------------------------------------------------------------------ district measures (de-duplicated match)

def student_counts_left(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.student_counts(r.s_undup, S, r.dim)


def student_counts_right(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.student_counts(r.p_undup, P, r.dim)


def student_count_comparison(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.student_count_comparison(r.p_rows, r.s_rows, P, S, r.dim)


def student_count_comparison_dedup(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.student_count_comparison(r.p_undup, r.s_undup, P, S, r.dim)


def eligibility_comparison(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.eligibility_comparison(r.slim_table, S, P, r.dim)


def _mismatch(measure, **options):
    def q(spark, sf_dir):
        r = rec(spark, sf_dir, **options)
        table = r.address_table if measure == "address_mismatch_count" else r.slim_table
        return M.mismatch_report(table, measure, S, r.dim)
    return q


def standardized_addresses(spark, sf_dir):
    rows = prepare_side(raw_rosters(spark, sf_dir)[0], S)
    a = S.col("student_address1")
    return rows.select(S.col("seq"), a, standardize_address(a).alias("standardized_address"))


def address_similarity(spark, sf_dir):
    r = rec(spark, sf_dir, transpositions=ORACLE_TRANSPOSITIONS)
    sim = M.address_similarity(S, P, ORACLE_TRANSPOSITIONS)
    return r.match.select("join_key", F.round(sim, 6).alias("addr_similarity"))


def id_length_counts(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.id_length_counts(r.s_undup, r.p_undup, S, P, r.dim)


def id_length_counts_raw(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.id_length_counts(r.s_rows, r.p_rows, S, P, r.dim)


def matched_students(spark, sf_dir):
    r = rec(spark, sf_dir)
    return M.matched_students(r.slim_table, S, r.dim)


def repeated_students_left(spark, sf_dir):
    return M.repeated_students(rec(spark, sf_dir).s_rows, S)


def repeated_students_right(spark, sf_dir):
    return M.repeated_students(rec(spark, sf_dir).p_rows, P)


def districts_per_key(spark, sf_dir):
    return M.districts_per_key(rec(spark, sf_dir).s_rows, S)


def district_count(spark, sf_dir):
    return M.district_count(rec(spark, sf_dir).p_rows, P)


def invalid_district_ids(spark, sf_dir):
    return M.invalid_district_ids(rec(spark, sf_dir).p_rows, P)


def invalid_district_count(spark, sf_dir):
    return M.invalid_district_count(rec(spark, sf_dir).p_rows, P)


def valid_district_rows_q(spark, sf_dir):
    return valid_district_rows(rec(spark, sf_dir).s_rows, S.col("aun9_3"))


def aun_formatting(spark, sf_dir):
    rows = rec(spark, sf_dir).s_rows
    a = S.col("aun9_3")
    upload = F.concat(F.lit("roster_1_"), plain_aun(a), F.lit("_2025.csv"))
    meal = F.concat(F.lit("x"), plain_aun(a), F.lit("_meals.csv"))
    return rows.select(
        S.col("seq"), a, upload.alias("upload_file"), meal.alias("meal_file"),
        format_aun(aun_from_filename(upload, UPLOAD_FILE_AUN)).alias("aun_from_upload_file"),
        format_aun(aun_from_filename(meal, MEAL_FILE_AUN)).alias("aun_from_meal_file"),
        plain_aun(a).alias("plain_aun"), numeric_aun(a).alias("numeric_aun"),
    )


def frequency_table(spark, sf_dir):
    dups = M.repeated_students(rec(spark, sf_dir).p_rows, P)
    return M.frequency_table(dups, "num_duplicated_join_keys")


def frequency_report(spark, sf_dir):
    return M.frequency_report(rec(spark, sf_dir).s_rows, S.col("eligibility"))


def district_summary_q(spark, sf_dir):
    return rec(spark, sf_dir, transpositions=ORACLE_TRANSPOSITIONS).summary()


def district_summary_raw_q(spark, sf_dir):
    return rec(spark, sf_dir).summary_raw()


def crosstab_row_percent(spark, sf_dir):
    r = rec(spark, sf_dir, transpositions=ORACLE_TRANSPOSITIONS)
    return M.crosstab_row_percent(M.address_value_missing(r.address_table, S, r.dim), "schl_type", "missing_address_count")


def difference_histogram(spark, sf_dir):
    r = rec(spark, sf_dir)
    dups = M.repeated_students(r.p_rows, P)
    totals = M.side_counts(r.p_undup, P, "total_students").select(
        plain_aun(P.col("aun9_3")).alias("AUN"), "total_students")
    # several raw id forms of one district fold into its plain id first
    totals = totals.groupBy("AUN").agg(F.sum("total_students").alias("total_students"))
    per_district = dups.join(totals, "AUN")
    return M.difference_histogram(per_district, "num_duplicated_join_keys", "total_students", HISTOGRAM_WIDTH)


def district_lookup_name(spark, sf_dir):
    return find_district(student_counts_left(spark, sf_dir), LOOKUP_NAME_FRAGMENT)


def district_lookup_ids(spark, sf_dir):
    return districts_in(student_counts_left(spark, sf_dir), LOOKUP_IDS)


def first_last_districts(spark, sf_dir):
    return M.head_tail(id_length_counts(spark, sf_dir), "AUN", HEAD_TAIL_ROWS)


def _roster_csv_folder(spark, sf_dir) -> str:
    """The student roster written once as a folder of CSV files (NULL written as ``NA``)."""
    def build():
        s_raw = raw_rosters(spark, sf_dir)[0]
        folder = snapshot_path(spark, sf_dir, "s_csv")
        (s_raw.select(*INTAKE_NAMES)
         .write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(folder))
        return folder
    return _memo(spark, ("csv", sf_dir), build)


def csv_intake_roster(spark, sf_dir):
    """The student roster's CSV folder taken in by the strict batch intake: the 25 cleaned fields."""
    def build():
        return intake_batch(spark, _roster_csv_folder(spark, sf_dir), S, snapshot_path(spark, sf_dir, "s_intake"))
    rows = _memo(spark, ("intake", sf_dir), build)
    return rows.select(*S.cols(INTAKE_NAMES))


def streamed_intake_roster(spark, sf_dir):
    """The same CSV folder taken in by the streaming intake (availableNow: every file once,
    appended to a snapshot), then the snapshot's 25 cleaned fields."""
    def build():
        folder = _roster_csv_folder(spark, sf_dir)
        sink = snapshot_path(spark, sf_dir, "s_stream")
        query = start_intake_stream(spark, folder, S, sink, sink + "_checkpoint")
        query.awaitTermination()
        return sink
    sink = _memo(spark, ("stream", sf_dir), build)
    return spark.read.parquet(sink).select(*S.cols(INTAKE_NAMES))


def csv_file_report(spark, sf_dir):
    """The folder report of the same CSV files, summed by status (file names are not reproducible in SQL)."""
    folder = _roster_csv_folder(spark, sf_dir)
    report = folder_report(spark, folder, scan_rosters(spark, folder, mode="lenient"))
    return report.groupBy("status").agg(
        F.min("header_fields").alias("header_fields"), F.sum("rows").alias("rows"),
        F.sum("bad_width_rows").alias("bad_width_rows"), F.sum("blank_first_name_rows").alias("blank_first_name_rows"))


def combined_batches(spark, sf_dir):
    return _combined(spark, sf_dir).select("batch", *S.cols(INTAKE_NAMES))


def dedup_combined_batches(spark, sf_dir):
    """De-duplication over the combined batches: of equally complete rows the one of the earlier
    batch stays. Key, missing count and batch of the kept rows."""
    rows = keyed_side(_combined(spark, sf_dir), S, prepared=True)
    return dedup_by_key(rows, S, ORDER).select("join_key", S.col("missing_count"), "batch")


def _combined(spark, sf_dir):
    """Batch intake end to end: the student roster written as two CSV batch folders
    (rows with validation output "valid" in batch b1, the rest in b2), each taken in by
    the strict intake, then stacked with batch labels keeping well-formed district ids."""
    def build():
        s_raw = raw_rosters(spark, sf_dir)[0].select(*INTAKE_NAMES)
        root = snapshot_path(spark, sf_dir, "s_batches")
        in_b1 = F.coalesce(F.col("validation_output") == "valid", F.lit(False))
        snaps = {}
        for name, cond in (("b1", in_b1), ("b2", ~in_b1)):
            (s_raw.filter(cond).write.mode("overwrite")
             .option("header", True).option("nullValue", "NA").csv(f"{root}/{name}_csv"))
            intake_batch(spark, f"{root}/{name}_csv", S, f"{root}/{name}_snap")
            snaps[name] = f"{root}/{name}_snap"
        return combine_batches(spark, snaps, S, f"{root}/all")
    return _memo(spark, ("batches", sf_dir), build)


# The sheet layout the dimension loader expects (three leading rows, then a
# header whose second "AUN" column holds the plain id).
SHEET_LEADING_ROWS = ("District sheet", "", "exported for matching")
SHEET_HEADER = "AUN,SFA Name,AUN,Schl Type"


def district_dimension_load(spark, sf_dir):
    """The district dimension written as a sheet-style CSV (leading rows, raw header names,
    a dashed and a plain id column), then read back by ``load_districts``."""
    def build():
        dim = fixtures.district_dimension(spark, sf_dir)
        body = dim.select(
            F.lit(1).alias("_part"), F.col("aun_2").alias("_k"),
            F.concat_ws(",", format_aun("aun_2"), "sfa_name", "aun_2", "schl_type").alias("value"))
        head = spark.createDataFrame(
            [(0, f"{i:02d}", line) for i, line in enumerate(SHEET_LEADING_ROWS + (SHEET_HEADER,))],
            "_part int, _k string, value string")
        folder = snapshot_path(spark, sf_dir, "districts_csv")
        # one file (the dimension is one row per district): line order is the sheet's row order
        (head.unionByName(body).repartition(1).sortWithinPartitions("_part", "_k")
         .select("value").write.mode("overwrite").text(folder))
        return folder
    return load_districts(spark, _memo(spark, ("districts_csv", sf_dir), build))


def consolidated_roster(spark, sf_dir):
    s_raw, p_raw, _ = raw_rosters(spark, sf_dir)
    return consolidate_rosters(s_raw, p_raw)


def _consolidated(side, raw_of, pattern, file_name):
    """One roster kind through ``consolidate_folder``: half of the rows, those with a 9-digit district id, as
    DC-only CSV files named by district, all others as the Full User intake snapshot."""
    def q(spark, sf_dir):
        def build():
            raw = raw_of(raw_rosters(spark, sf_dir))
            folder = snapshot_path(spark, sf_dir, side.prefix + "dc_only")
            district = plain_aun("aun9_3")
            in_file = (F.col("seq") % 4 < 2) & F.coalesce(district.rlike(r"^\d{9}$"), F.lit(False))
            dc = raw.filter(in_file)
            write_named_csv(dc.select(*INTAKE_NAMES, district.alias("district")), "district", folder, file_name)
            full = write_snapshot(prepare_side(raw.filter(~in_file).select(*INTAKE_NAMES), side),
                                  snapshot_path(spark, sf_dir, side.prefix + "full_user"))
            return folder, full
        folder, full = _memo(spark, ("consolidate", side.prefix, sf_dir), build)
        return consolidate_folder(spark, folder, pattern, full)
    return q


# ------------------------------------------------------------------ raw many-to-many measures

def _raw(kind):
    def q(spark, sf_dir):
        r = rec(spark, sf_dir)
        t = r.pair_measures(kind)
        if kind == "eligibility":
            return M.eligibility_comparison(t, S, P, r.dim)
        if kind == "matched":
            return M.matched_students(t, S, r.dim)
        return M.mismatch_report(t, kind, S, r.dim)
    return q


def _raw_parent_and(spark, sf_dir):
    r = rec(spark, sf_dir, parent_mode="and")
    return M.mismatch_report(r.pair_measures("parent_name_mismatch_count"), "parent_name_mismatch_count", S, r.dim)


def _parent_and(spark, sf_dir):
    r = rec(spark, sf_dir, parent_mode="and")
    return M.mismatch_report(r.slim_table, "parent_name_mismatch_count", S, r.dim)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_roster": clean_roster,
    "match_keys_name_dob": match_keys_name_dob,
    "match_keys_by_id_length": match_keys_by_id_length,
    "missing_counts": missing_counts,
    "dedup_roster": dedup_roster,
    "dedup_roster_by_id_length": dedup_roster_by_id_length,
    "duplicate_flags": duplicate_flags_q,
    "duplicate_profile": duplicate_profile,
    "repeated_secure_ids": repeated_secure_ids,
    "match_one_to_one": match_one_to_one,
    "match_many_to_many": match_many_to_many,
    "unmatched_left": unmatched_left,
    "unmatched_right": unmatched_right,
    "unmatched_ids": unmatched_ids_q,
    "keys_duplicated_both_sides": keys_duplicated_both_sides_q,
    "student_counts_left": student_counts_left,
    "student_counts_right": student_counts_right,
    "student_count_comparison": student_count_comparison,
    "student_count_comparison_dedup": student_count_comparison_dedup,
    "eligibility_comparison": eligibility_comparison,
    "site_code_mismatches": _mismatch("school_code_mismatch_count"),
    "parent_name_mismatches": _mismatch("parent_name_mismatch_count"),
    "parent_name_mismatches_and": _parent_and,
    "standardized_addresses": standardized_addresses,
    "address_similarity": address_similarity,
    "address_mismatches": _mismatch("address_mismatch_count", transpositions=ORACLE_TRANSPOSITIONS),
    "case_number_mismatches": _mismatch("case_number_mismatch_count"),
    "id_length_counts": id_length_counts,
    "id_length_counts_raw": id_length_counts_raw,
    "matched_students": matched_students,
    "repeated_students_left": repeated_students_left,
    "repeated_students_right": repeated_students_right,
    "districts_per_key": districts_per_key,
    "district_count": district_count,
    "invalid_district_ids": invalid_district_ids,
    "invalid_district_count": invalid_district_count,
    "valid_district_rows": valid_district_rows_q,
    "aun_formatting": aun_formatting,
    "frequency_table": frequency_table,
    "frequency_report": frequency_report,
    "crosstab_row_percent": crosstab_row_percent,
    "difference_histogram": difference_histogram,
    "district_lookup_name": district_lookup_name,
    "district_lookup_ids": district_lookup_ids,
    "district_summary": district_summary_q,
    "district_summary_raw": district_summary_raw_q,
    "consolidated_roster": consolidated_roster,
    "consolidated_upload": _consolidated(S, lambda r: r[0], UPLOAD_FILE_AUN, "roster_1_{name}_{k}.csv"),
    "consolidated_meal": _consolidated(P, lambda r: r[1], MEAL_FILE_AUN, "x{name}_{k}.csv"),
    "csv_intake_roster": csv_intake_roster,
    "csv_file_report": csv_file_report,
    "streamed_intake_roster": streamed_intake_roster,
    "district_dimension_load": district_dimension_load,
    "combined_batches": combined_batches,
    "dedup_combined_batches": dedup_combined_batches,
    "first_last_districts": first_last_districts,
    "eligibility_comparison_raw": _raw("eligibility"),
    "site_code_mismatches_raw": _raw("school_code_mismatch_count"),
    "parent_name_mismatches_raw": _raw("parent_name_mismatch_count"),
    "parent_name_mismatches_raw_and": _raw_parent_and,
    "case_number_mismatches_raw": _raw("case_number_mismatch_count"),
    "matched_students_raw": _raw("matched"),
}

# The flagship: site code mismatches per district, end to end.
FLAGSHIP = "site_code_mismatches"

__all__ = ["QUERIES", "FLAGSHIP", "INTAKE_NAMES", "rec"]
