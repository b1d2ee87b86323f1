"""District measures and the combined summary, written one dataset per measure.

Names follow the master data sheet columns the measures fill:
CG/CH students per district, CJ-CL eligibility, CS site codes, CT guardian names,
CU addresses, CV case numbers, CW/CX 10-character ids, CY matched students,
CZ/DA repeated students.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollmatch.operators import measures as M
from rollmatch.plans.reconcile import Reconciliation
from rollmatch.sources.export import export_measures


def district_reports(r: Reconciliation, dedup: bool = True) -> dict[str, DataFrame]:
    """Every per-district report. ``dedup=False`` computes the match measures over the
    raw many-to-many match (counted from aggregates; the address measure needs the
    de-duplicated match and is left out there)."""
    s, p = r.s, r.p
    s_side = r.s_undup if dedup else r.s_rows
    p_side = r.p_undup if dedup else r.p_rows
    table = r.slim_table if dedup else r.pair_table
    out = {
        "cg_students_p": M.student_counts(p_side, p, r.dim),
        "ch_students_s": M.student_counts(s_side, s, r.dim),
        "cj_cl_eligibility": M.eligibility_comparison(table, s, p, r.dim),
        "cs_site_code_mismatches": M.mismatch_report(table, "school_code_mismatch_count", s, r.dim),
        "ct_parent_name_mismatches": M.mismatch_report(table, "parent_name_mismatch_count", s, r.dim),
        "cv_case_number_mismatches": M.mismatch_report(table, "case_number_mismatch_count", s, r.dim),
        "cw_cx_ids_len10": M.id_length_counts(s_side, p_side, s, p, r.dim),
        "cy_matched_students": M.matched_students(table, s, r.dim),
        "cz_repeated_students_p": M.repeated_students(r.p_rows, p, r.order),
        "da_repeated_students_s": M.repeated_students(r.s_rows, s, r.order),
    }
    if dedup:
        out["cu_address_mismatches"] = M.mismatch_report(r.address_table, "address_mismatch_count", s, r.dim)
    return out


def write_reports(r: Reconciliation, out_dir: str, fmt: str = "parquet", dedup: bool = True) -> dict[str, str]:
    """Checkpoint the de-duplicated sides once, then write every report and the summary."""
    if dedup:
        r.materialize()
    reports = district_reports(r, dedup)
    reports["summary"] = r.summary() if dedup else r.summary_raw()
    return export_measures(reports, out_dir, fmt)
