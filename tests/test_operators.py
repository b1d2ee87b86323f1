"""Operators on hand-made rosters: keys, missing counts, de-duplication, matching, measures."""

import pytest
from pyspark.sql import functions as F

from rollmatch.operators import measures as M
from rollmatch.operators.cleaning import prefix_columns, prepare_side, relabel, require
from rollmatch.operators.dimension import enrich, prepare_dimension
from rollmatch.operators.keys import dedup_by_key, duplicate_flags, keyed
from rollmatch.operators.matching import (
    keys_duplicated_both_sides,
    matched_rows,
    pair_counts,
    unmatched,
    unmatched_ids,
)
from rollmatch.plans.reconcile import reconcile
from rollmatch.schema import INTAKE_NAMES, MEAL, STUDENT
from tests.conftest import rows

S, P = STUDENT, MEAL
SCHEMA = "seq long, " + ", ".join(f"{n} string" for n in INTAKE_NAMES)


def roster(spark, recs):
    full = []
    for seq, r in enumerate(recs):
        base = {n: "v" for n in INTAKE_NAMES}
        base.update({"aun9_3": "111-11-111-1", "pasecureid": "0000000001", "student_first_name": "Ann",
                     "student_last_name": "Lee", "student_dob": "2010-01-01"})
        base.update(r)
        full.append((r.get("seq", seq),) + tuple(base[n] for n in INTAKE_NAMES))
    return spark.createDataFrame(full, SCHEMA)


def dim(spark):
    return spark.createDataFrame([("111111111", "District A", "Public"), ("222222222", "District B", "Charter")],
                                 "aun_2 string, sfa_name string, schl_type string")


def test_prepare_side_cleans_and_requires_ids(spark):
    df = roster(spark, [
        {"aun9_3": " 111-11-111-1 ", "student_first_name": " ANN\t"},
        {"aun9_3": ""}, {"aun9_3": None}, {"pasecureid": None}, {"pasecureid": ""},
    ])
    out = prepare_side(df, S)
    assert rows(out, "s_seq", "s_aun9_3", "s_student_first_name") == [(0, "111-11-111-1", "ann")]
    assert all(c.startswith("s_") for c in out.columns)


def test_key_policies(spark):
    df = prepare_side(roster(spark, [
        {"pasecureid": "0000000001"}, {"pasecureid": "123", "seq": 1}, {"student_first_name": None, "seq": 2},
    ]), S)
    name_dob = {r[0]: r[1] for r in keyed(df, S, "name_dob").select("s_seq", "join_key").collect()}
    by_len = {r[0]: r[1] for r in keyed(df, S, "by_id_length").select("s_seq", "join_key").collect()}
    assert name_dob[0] == "111-11-111-1_ann_lee_2010-01-01"
    assert name_dob[2] == "111-11-111-1_NA_lee_2010-01-01"
    assert by_len[0] == "111-11-111-1_0000000001"
    assert by_len[1] == "111-11-111-1_ann_lee_2010-01-01"


def test_missing_count_counts_null_not_blank(spark):
    df = prepare_side(roster(spark, [{"county": None, "parent_email": None, "school_name": ""}]), S)
    assert keyed(df, S).first()["s_missing_count"] == 2


def test_dedup_keeps_fewest_missing_then_first_in_order(spark):
    df = keyed(prepare_side(roster(spark, [
        {"seq": 5, "county": None}, {"seq": 7}, {"seq": 3, "county": None},
        {"seq": 9}, {"seq": 1, "student_first_name": "Bob", "county": None},
    ]), S), S)
    out = dedup_by_key(df, S)
    assert rows(out, "s_seq") == [(1,), (7,)]
    assert rows(dedup_by_key(out, S), "s_seq") == [(1,), (7,)]  # idempotent


def test_duplicate_flags_mark_all_but_first(spark):
    df = keyed(prepare_side(roster(spark, [{"seq": 4}, {"seq": 2}, {"seq": 8}, {"seq": 6, "student_dob": "x"}]), S), S)
    flags = dict(duplicate_flags(df, S).select("s_seq", "is_duplicate").collect())
    assert flags == {2: False, 4: True, 8: True, 6: False}


def _sides(spark, s_recs, p_recs, policy="name_dob"):
    return reconcile(roster(spark, s_recs), roster(spark, p_recs), prepare_dimension(dim(spark)), policy)


def test_match_unmatched_identities(spark):
    r = _sides(spark,
               [{"student_first_name": n} for n in ("a", "b", "b", "c")],
               [{"student_first_name": n} for n in ("b", "c", "c", "d", "e")])
    assert r.match.count() == 2
    assert r.match.select("join_key").distinct().count() == 2
    p_total = r.p_rows.count()
    assert matched_rows(r.p_rows, r.s_rows).count() + unmatched(r.p_rows, r.s_rows).count() == p_total
    assert rows(unmatched(r.s_rows, r.p_rows), "s_student_first_name") == [("a",)]
    pc = {row["join_key"].split("_")[1]: row["pairs"] for row in pair_counts(r.p_rows, r.s_rows, P, S).collect()}
    assert pc == {"b": 2, "c": 2}
    dd = keys_duplicated_both_sides(r.p_rows, r.s_rows, P, S).collect()
    assert dd == []


def test_unmatched_ids_within_district(spark):
    r = _sides(spark,
               [{"pasecureid": "1"}, {"pasecureid": "2"}, {"pasecureid": "2", "student_first_name": "Zed"}],
               [{"pasecureid": "2"}, {"pasecureid": "3"}, {"pasecureid": "1", "aun9_3": "222-22-222-2"}])
    got = rows(unmatched_ids(r.p_rows, r.s_rows, P, S), "AUN", "PAsecureID", "Source")
    assert got == [("111-11-111-1", "1", "student_upload"), ("111-11-111-1", "3", "meal_system"),
                   ("222-22-222-2", "1", "meal_system")]


def test_match_measures_one_pass(spark):
    s = [
        {"student_first_name": "a", "school_code4": "0001", "case_number": "C1", "eligibility": "Free",
         "parent_first_name": "x", "parent_last_name": "y", "student_address1": "12 Main Street"},
        {"student_first_name": "b", "school_code4": None, "case_number": "C2", "eligibility": "PAID",
         "parent_first_name": "x", "parent_last_name": None, "student_address1": "5 Oak Avenue"},
        {"student_first_name": "c", "school_code4": "", "case_number": None, "eligibility": "unknown",
         "parent_first_name": "x", "parent_last_name": "y", "student_address1": ""},
    ]
    p = [
        {"student_first_name": "a", "school_code4": "0002", "case_number": "C1", "eligibility": "free",
         "parent_first_name": " X ", "parent_last_name": "z", "student_address1": "12 main st."},
        {"student_first_name": "b", "school_code4": "0003", "case_number": "X2", "eligibility": "reduced",
         "parent_first_name": "x", "parent_last_name": "q", "student_address1": "99 Far Away Boulevard"},
        {"student_first_name": "c", "school_code4": "0009", "case_number": "C3", "eligibility": None,
         "parent_first_name": "w", "parent_last_name": "v", "student_address1": "1 Elm Road"},
    ]
    r = _sides(spark, s, p)
    t = r.table.first().asDict()
    assert t["matched"] == 3
    assert (t["s_free"], t["s_paid"], t["s_reduced"]) == (1, 1, 0)
    assert (t["p_free"], t["p_paid"], t["p_reduced"]) == (1, 0, 1)
    assert t["school_code_mismatch_count"] == 2       # 0001/0002 and ''/0009; NULL skipped
    assert t["case_number_mismatch_count"] == 1       # C2/X2
    assert t["parent_name_mismatch_count"] == 2       # a (last differs), c (both differ)
    assert t["address_mismatch_count"] == 1           # b; a equal after rules; c blank skipped
    r_and = reconcile(roster(spark, s), roster(spark, p), prepare_dimension(dim(spark)), parent_mode="and")
    assert r_and.table.first()["parent_name_mismatch_count"] == 1


def test_reports_shape_and_enrichment(spark):
    r = _sides(spark, [{"school_code4": "1"}, {"student_first_name": "b", "school_code4": "1"}],
               [{"school_code4": "2"}, {"student_first_name": "b", "school_code4": "1"}])
    rep = M.mismatch_report(r.table, "school_code_mismatch_count", S, r.dim).collect()
    assert [tuple(x) for x in rep] == [(111111111.0, 1, "District A", "Public")]
    elig = M.eligibility_comparison(r.table, S, P, r.dim).collect()
    assert elig == []  # no counted eligibility value on either side -> no row


def test_pair_measures_equal_naive_many_to_many(spark):
    s = [{"student_first_name": "a", "school_code4": c, "case_number": k, "parent_last_name": pl, "eligibility": e}
         for c, k, pl, e in (("1", "C1", "y", "free"), ("2", None, "y", "paid"), (None, "C1", None, "FREE"),
                             ("1", "C9", "z", "reduced"))]
    s += [{"student_first_name": "b", "school_code4": "7"}]
    p = [{"student_first_name": "a", "school_code4": c, "case_number": k, "parent_last_name": pl, "eligibility": e}
         for c, k, pl, e in (("1", "C1", "y", "free"), ("3", "C1", "Y ", None), ("2", "C2", "y", "paid"))]
    p += [{"student_first_name": "b", "school_code4": "8"}, {"student_first_name": "b", "school_code4": "7"}]
    r = _sides(spark, s, p)
    fast = r.pair_table.drop("s_aun9_3").first().asDict()
    pairs = r.p_rows.join(r.s_rows, "join_key")
    naive = M.match_measure_table(pairs, S, P).drop("s_aun9_3", "address_mismatch_count").first().asDict()
    assert fast == naive
    for mode in ("and",):
        r2 = reconcile(roster(spark, s), roster(spark, p), prepare_dimension(dim(spark)), parent_mode=mode)
        fast2 = r2.pair_table.first()["parent_name_mismatch_count"]
        naive2 = M.match_measure_table(r2.p_rows.join(r2.s_rows, "join_key"), S, P, mode).first()[
            "parent_name_mismatch_count"]
        assert fast2 == naive2


def test_side_measures(spark):
    r = _sides(spark, [{"pasecureid": "0000000001"}, {"pasecureid": "12", "student_first_name": "b"},
                       {"pasecureid": "0000000003", "student_first_name": "b"}],
               [{"pasecureid": "0000000001"}])
    ids = M.id_length_counts(r.s_rows, r.p_rows, S, P, r.dim).collect()
    assert [(x["AUN"], x["s_ids_len10"], x["p_ids_len10"]) for x in ids] == [(111111111.0, 2, 1)]
    rep = M.repeated_students(r.s_rows, S).collect()
    assert [tuple(x) for x in rep] == [("111111111", 1, 2)]
    per_key = {x["join_key"].split("_")[1]: (x["n"], x["auns_per_student"]) for x in
               M.districts_per_key(r.s_rows, S).collect()}
    assert per_key == {"ann": (1, 1), "b": (2, 1)}
    sec = {x["s_pasecureid"]: x["num_duplicated_join_keys"] for x in M.repeated_secure_ids(r.s_rows, S, r.dim).collect()}
    assert sec == {"0000000001": 0, "12": 0, "0000000003": 0}


def test_strict_sum_nulls_out_district(spark):
    df = prepare_side(roster(spark, [{}, {"pasecureid": "x"}]), S)
    df = df.withColumn("s_pasecureid", F.when(F.col("s_seq") == 1, None).otherwise(F.col("s_pasecureid")))
    assert M.ids_len10(df, S).first()["s_ids_len10"] is None


def test_count_comparison_full_outer_fills_zero(spark):
    r = _sides(spark, [{}], [{"aun9_3": "222-22-222-2"}])
    got = rows(M.student_count_comparison(r.p_rows, r.s_rows, P, S, r.dim), "AUN", "s_total", "p_total", "difference")
    assert got == [(111111111.0, 1, 0, -1), (222222222.0, 0, 1, 1)]


def test_profile_frequency_crosstab_histogram(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    prof = {(x["is_duplicated"]): (x["n"], x["percent"]) for x in M.duplicate_profile(df, "v", "v").collect()}
    assert prof == {False: (3, 0.75), True: (1, 0.25)}
    freq = [tuple(x) for x in M.frequency_table(df, "v").collect()]
    assert sorted(freq, key=lambda t: (t[0] is None, t[0] or 0)) == [(1, 2, 0.5, 0.5), (2, 1, 0.25, 0.75),
                                                                      (None, 1, 0.25, 1.0)]
    ct = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1)], "t string, f int")
    got = {x["t"]: (x["n_0"], x["n_1"], x["pct_1"]) for x in M.crosstab_row_percent(ct, "t", "f").collect()}
    assert got == {"a": (1, 1, 0.5), "b": (0, 1, 1.0)}
    h = spark.createDataFrame([(5, 1), (3, 20), (1, 1)], "a long, b long")
    hist = sorted(tuple(x) for x in M.difference_histogram(h, "a", "b", 10).collect())
    assert hist == [(-20, 1, -10), (0, 2, 10)]


def test_enrich_requires_unique_dimension(spark):
    bad = spark.createDataFrame([("1", "a", "t"), ("1", "b", "t")], "aun_2 string, sfa_name string, schl_type string")
    with pytest.raises(ValueError):
        prepare_dimension(bad)
    df = spark.createDataFrame([("111111111",), (None,)], "AUN string")
    got = rows(enrich(df, prepare_dimension(dim(spark))), "AUN", "sfa_name")
    assert got == [("111111111", "District A"), (None, None)]


def test_relabel_prefix_require(spark):
    df = spark.createDataFrame([("a", "b", "c")], "x string, y string, z string")
    assert relabel(df, ["p", "q"]).columns == ["p", "q", "z"]
    assert prefix_columns(df, "s_", keep=["z"]).columns == ["s_x", "s_y", "z"]
    assert require(df.withColumn("y", F.lit("")), ["y"]).count() == 0


def test_frequency_table_of_many_values(spark):
    # a six-digit number of distinct values, NULLs, and shares that end at 1
    df = spark.range(0, 300_000).select(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 130_000).alias("v"))
    out = M.frequency_table(df, "v")
    expected = df.groupBy("v").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("v", na_position="last")
    got = out.toPandas().sort_values("cum_percent")
    assert len(got) == len(expected) > 100_000
    assert got["n"].tolist() == expected["n"].tolist()
    assert abs(got["cum_percent"].iloc[-1] - 1) < 1e-12 and (got["cum_percent"].diff().dropna() > 0).all()
    assert (got["cum_percent"] - expected["n"].cumsum().to_numpy() / 300_000).abs().max() < 1e-9


def test_frequency_report_has_valid_shares_total_and_missing(spark):
    from rollmatch.operators.measures import frequency_report

    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    got = {(r["kind"], r["value"]): tuple(r)[2:] for r in frequency_report(df, "x").collect()}
    assert got == {("value", "a"): (1, 1 / 3, 0.25, 1 / 3), ("value", "b"): (2, 2 / 3, 0.5, 1.0),
                   ("total", None): (3, 1.0, 0.75, 1.0), ("missing", None): (1, None, 0.25, None)}
    empty = sorted(tuple(r) for r in frequency_report(df.limit(0), "x").collect())
    assert empty == [("missing", None, 0, None, None, None), ("total", None, 0, None, None, None)]
    nothing = {r["kind"]: tuple(r)[2:] for r in frequency_report(df.filter("x IS NULL"), "x").collect()}
    assert nothing == {"total": (0, None, 0.0, None), "missing": (1, None, 1.0, None)}
