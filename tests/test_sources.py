"""Reader files in a temp folder, district dimension loading, exports, intake, streaming."""

import os
import time

import pytest

from rollmatch.operators.dimension import prepare_dimension
from rollmatch.plans.consolidate import LAYOUT, consolidate, dc_only, full_user
from rollmatch.plans.intake import combine_batches, intake_batch
from rollmatch.plans.reconcile import reconcile
from rollmatch.plans.reports import district_reports, write_reports
from rollmatch.schema import CONSOLIDATED_NAMES, INTAKE_NAMES, MEAL, STUDENT
from rollmatch.sources.csv import ORDER, folder_report, headers, row_report, scan_rosters
from rollmatch.sources.districts import clean_names, load_districts
from rollmatch.sources.export import export_csv
from rollmatch.streaming.intake import start_intake_stream

HEADER = ",".join(f"col{i}" for i in range(25))


def line(values):
    return ",".join(values)


def row25(**over):
    vals = {n: f"{n[:3]}" for n in INTAKE_NAMES}
    vals.update({"aun9_3": "111-11-111-1", "pasecureid": "0000000001", "student_first_name": "Ann",
                 "student_last_name": "Lee", "student_dob": "2010-01-01"})
    vals.update(over)
    return [vals[n] for n in INTAKE_NAMES]


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_positional_binding_quotes_blanks(spark, tmp_path):
    d = str(tmp_path / "ok")
    quoted = row25(school_name='"Say ""hi"" \\ there"', student_address1='"12 Main\nSt"')
    blanks = row25(county="", parent_email='""', case_number="NA", eligibility='"NA"')
    write(d, "ok.csv", HEADER + "\n" + line(row25()) + "\n" + line(quoted) + "\n" + line(blanks) + "\n")
    df = scan_rosters(spark, d)
    got = df.orderBy(*ORDER).collect()
    assert len(got) == 3 and all(not r["bad_width"] for r in got)
    assert got[1]["school_name"] == 'Say "hi" \\ there'
    assert got[1]["student_address1"] == "12 Main\nSt"
    assert got[2]["county"] == "" and got[2]["parent_email"] == ""
    assert got[2]["case_number"] is None and got[2]["eligibility"] is None
    nulls = scan_rosters(spark, d, blank="null").orderBy(*ORDER).collect()
    assert nulls[2]["county"] is None


def test_strict_and_lenient_widths(spark, tmp_path):
    d = str(tmp_path / "w")
    write(d, "narrow.csv", ",".join(f"c{i}" for i in range(24)) + "\n" + line(row25()[:24]) + "\n")
    write(d, "wide.csv", HEADER + ",extra\n" + line(row25() + ["x"]) + "\n")
    write(d, "good.csv", HEADER + "\n" + line(row25()) + "\n")
    with pytest.raises(ValueError, match="narrow.csv"):
        scan_rosters(spark, d, mode="strict", check=True)
    df = scan_rosters(spark, d, mode="lenient")
    by_file = {r["src_file"]: r for r in df.collect()}
    assert by_file["narrow.csv"]["validation_output"] is None          # padded
    assert by_file["narrow.csv"]["enrollment_end"] == "enr"            # present field kept
    assert by_file["wide.csv"]["validation_output"] == "val"           # cut after 25
    rep = {r["src_file"]: (r["rows"], r["bad_width_rows"], r["blank_first_name_rows"])
           for r in row_report(df).collect()}
    assert rep == {"narrow.csv": (1, 1, 0), "wide.csv": (1, 1, 0), "good.csv": (1, 0, 0)}


def test_header_only_empty_and_hidden_files(spark, tmp_path):
    d = str(tmp_path / "h")
    write(d, "header_only.csv", HEADER + "\n")
    write(d, "empty.csv", "")
    write(d, "notes.txt", "ignored")
    assert scan_rosters(spark, d, mode="lenient").count() == 0
    write(d, "_skip.csv", HEADER + "\n" + line(row25()) + "\n")
    with pytest.raises(ValueError, match="_skip.csv"):
        scan_rosters(spark, d)


def test_clean_names_and_load_districts(spark, tmp_path):
    assert clean_names(["AUN", "SFA Name", "AUN", "Schl Type", "% Free", "siteID"]) == [
        "aun", "sfa_name", "aun_2", "schl_type", "percent_free", "site_id"]
    assert clean_names(["Number of Duplicate Students"], max_len=25) == ["number_of_duplicate_stude"]
    d = str(tmp_path / "mds")
    write(d, "mds.csv", "title\n\nnotes,here\nAUN,SFA Name,AUN,Schl Type\nx,District A,111111111,Public\n"
                        "y,District B,222222222,Charter\n")
    got = sorted(tuple(r) for r in load_districts(spark, d).collect())
    assert got == [("111111111", "District A", "Public"), ("222222222", "District B", "Charter")]


def test_intake_reconcile_reports_end_to_end(spark, tmp_path):
    s_dir, p_dir = str(tmp_path / "s"), str(tmp_path / "p")
    s_rows = [row25(student_first_name=n, school_code4=c) for n, c in (("Ann", "1"), ("Bo", "2"), ("Bo", "2"))]
    p_rows = [row25(student_first_name=n, school_code4=c) for n, c in (("ann ", "9"), ("Bo", "2"), ("Cy", "3"))]
    write(s_dir, "b1.csv", HEADER + "\n" + "\n".join(line(r) for r in s_rows[:2]) + "\n")
    write(s_dir, "b2.csv", HEADER + "\n" + line(s_rows[2]) + "\n")
    write(p_dir, "p.csv", HEADER + "\n" + "\n".join(line(r) for r in p_rows) + "\n")
    s_snap = intake_batch(spark, s_dir, STUDENT, str(tmp_path / "snap_s"))
    p_snap = intake_batch(spark, p_dir, MEAL, str(tmp_path / "snap_p"))
    combined = combine_batches(spark, {"batch1": str(tmp_path / "snap_s")}, STUDENT, str(tmp_path / "all_s"))
    assert combined.count() == 3 and s_snap.count() == 3
    dim = prepare_dimension(spark.createDataFrame([("111111111", "District A", "Public")],
                                                  "aun_2 string, sfa_name string, schl_type string"))
    r = reconcile(combined, p_snap, dim, prepared=True, order=ORDER)
    assert r.match.count() == 2
    reports = district_reports(r)
    cs = reports["cs_site_code_mismatches"].collect()
    assert [(x["AUN"], x["school_code_mismatch_count"]) for x in cs] == [(111111111.0, 1)]
    out = write_reports(r, str(tmp_path / "reports"), fmt="csv")
    assert set(out) >= {"summary", "cu_address_mismatches", "cz_repeated_students_p"}
    summ = spark.read.option("header", True).csv(out["summary"]).collect()
    assert len(summ) == 1 and summ[0]["matched"] == "2"


def test_consolidation_and_csv_export(spark, tmp_path):
    rows = [tuple(row25(student_first_name=n)) + (f"x123456789_{i}.csv",) for i, n in enumerate(("A", "", None))]
    files = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CONSOLIDATED_NAMES) + ", source_file string")
    dc = dc_only(files, r"^x(\d{9}).*")
    got = dc.collect()
    assert len(got) == 1 and got[0]["AUN"] == "123-45-678-9" and got[0]["AUN_original"] == "111-11-111-1"
    assert dc.columns[:3] == ["LEAname", "AUN_original", "AUN"] and dc.columns[-1] == "usertype"
    fu = full_user(spark.createDataFrame([tuple(row25()) + ("extra",)],
                                         ", ".join(f"{c} string" for c in INTAKE_NAMES) + ", more string"))
    both = consolidate(dc, fu)
    assert both.count() == 2 and both.columns == [*LAYOUT] and len(LAYOUT) == 27
    path = str(tmp_path / "wide")
    export_csv(both, path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 2


def test_streaming_intake_is_incremental(spark, tmp_path):
    src, sink, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write(src, "b1.csv", HEADER + "\n" + line(row25()) + "\n" + line(row25(pasecureid="")) + "\n")
    q = start_intake_stream(spark, src, STUDENT, sink, ck)
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 1
    write(src, "b2.csv", HEADER + "\n" + line(row25(student_first_name="Bo")) + "\n")
    q = start_intake_stream(spark, src, STUDENT, sink, ck)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == 2
    assert sorted(r["s_src_file"] for r in out.collect()) == ["b1.csv", "b2.csv"]


def test_scan_batches_labels_rows(spark, tmp_path):
    from rollmatch.sources.csv import scan_batches

    write(str(tmp_path / "b1"), "a.csv", HEADER + "\n" + line(row25()) + "\n")
    write(str(tmp_path / "b2"), "b.csv", HEADER + "\n" + line(row25()) + "\n" + line(row25()) + "\n")
    df = scan_batches(spark, {"one": str(tmp_path / "b1"), "two": str(tmp_path / "b2")})
    assert sorted((r["batch"], r["src_file"]) for r in df.collect()) == [("one", "a.csv"), ("two", "b.csv"),
                                                                         ("two", "b.csv")]


def test_strict_intake_names_every_bad_file_and_keeps_the_old_snapshot(spark, tmp_path):
    d, snap = str(tmp_path / "in"), str(tmp_path / "snap")
    write(d, "good.csv", HEADER + "\n" + line(row25()) + "\n")
    assert intake_batch(spark, d, STUDENT, snap).count() == 1
    bad = {"four.csv": "a,b,c,d\n1,2,3,4\n", "semicolon.csv": (HEADER + "\n" + line(row25()) + "\n").replace(",", ";"),
           "header_only.csv": "a,b,c\n", "wide.csv": HEADER + ",x\n" + line(row25() + ["x"]) + "\n",
           "ragged.csv": HEADER + "\n" + line(row25()[:20]) + "\n"}
    for name, text in bad.items():
        write(d, name, text)
    with pytest.raises(ValueError) as e:
        intake_batch(spark, d, STUDENT, snap)
    assert all(name in str(e.value) for name in bad) and "good.csv" not in str(e.value)
    with pytest.raises(ValueError, match="header_only.csv"):
        scan_rosters(spark, d, check=True)
    old = spark.read.parquet(snap)
    assert [r["s_src_file"] for r in old.collect()] == ["good.csv"]
    lenient = intake_batch(spark, d, STUDENT, str(tmp_path / "lenient"), mode="lenient")
    assert {r["s_src_file"]: r["s_bad_width"] for r in lenient.collect()} == {"good.csv": False, "wide.csv": True, "ragged.csv": True}
    report = {r["src_file"]: r["n_rows"] for r in row_report(lenient, STUDENT).withColumnRenamed("rows", "n_rows").collect()}
    assert report == {"good.csv": 1, "wide.csv": 1, "ragged.csv": 1}


def test_folder_report_lists_every_file(spark, tmp_path):
    d = str(tmp_path / "in")
    write(d, "good.csv", HEADER + "\n" + line(row25()) + "\n" + line(row25(student_first_name="")) + "\n")
    write(d, "empty.csv", "")
    write(d, "header_only.csv", HEADER + "\n")
    write(d, "narrow.csv", "a,b\n1,2\n")
    write(d, "quoted.csv", HEADER.replace("col0", '"co,l0"') + "\n" + line(row25()) + "\n")
    got = {r["src_file"]: (r["header_fields"], r["rows"], r["bad_width_rows"], r["blank_first_name_rows"], r["status"])
           for r in folder_report(spark, d, scan_rosters(spark, d, mode="lenient")).collect()}
    assert got == {"good.csv": (25, 2, 0, 1, "ok"), "empty.csv": (None, 0, 0, 0, "unreadable or empty"),
                   "header_only.csv": (25, 0, 0, 0, "no rows"), "narrow.csv": (2, 1, 1, 1, "wrong width"), "quoted.csv": (25, 1, 0, 0, "ok")}
    assert headers(spark, d).filter("bad_header").count() == 1


def test_unclosed_quote_is_counted_in_linear_time(spark, tmp_path):
    d = str(tmp_path / "q")
    body = "\n".join(line(row25()) for _ in range(100_000))
    write(d, "open.csv", HEADER + "\n" + line(row25(school_name='"never closed')) + "\n" + body + "\n")
    began = time.perf_counter()
    with pytest.raises(ValueError, match="open.csv"):
        scan_rosters(spark, d, check=True)
    assert time.perf_counter() - began < 60


@pytest.mark.parametrize("second", ["a.csv", "z.csv"])
def test_the_first_batch_wins_ties(spark, tmp_path, second):
    from rollmatch.operators.keys import dedup_by_key
    from rollmatch.plans.reconcile import keyed_side

    t = str(tmp_path)
    write(f"{t}/b1", "z.csv", HEADER + "\n" + line(row25(school_code4="first")) + "\n")
    write(f"{t}/b2", second, HEADER + "\n" + line(row25(school_code4="second")) + "\n")
    for b in ("b1", "b2"):
        intake_batch(spark, f"{t}/{b}", STUDENT, f"{t}/snap_{b}")
    both = combine_batches(spark, {b: f"{t}/snap_{b}" for b in ("b1", "b2")}, STUDENT, f"{t}/all")
    kept = dedup_by_key(keyed_side(both, STUDENT, prepared=True), STUDENT, ORDER).collect()
    assert [(r["s_school_code4"], r["batch"]) for r in kept] == [("first", "b1")]


def test_load_districts_parquet_and_sorted_export(spark, tmp_path):
    from rollmatch.sources.export import export_measures

    src = spark.createDataFrame([("x", 222222222, "B", "Charter"), ("y", 111111111, "A", "Public")],
                                "AUN string, `AUN ` long, `SFA Name` string, `Schl Type` string")
    src.write.parquet(str(tmp_path / "mds"))
    got = load_districts(spark, str(tmp_path / "mds"), fmt="parquet")
    assert sorted(tuple(r) for r in got.collect()) == [("111111111", "A", "Public"), ("222222222", "B", "Charter")]
    out = export_measures({"m": got.withColumnRenamed("aun_2", "AUN")}, str(tmp_path / "out"), fmt="csv")
    back = [r["AUN"] for r in spark.read.option("header", True).csv(out["m"]).collect()]
    assert back == ["111111111", "222222222"]


def test_district_header_cells_with_line_breaks(spark, tmp_path):
    d = str(tmp_path / "wrapped")
    write(d, "mds.csv", 'Master list,"as of\nJuly"\n\nnotes\n"AUN\n(dashed)","SFA\nName",AUN,"Schl\nType"\n1-1,District A,111111111,Public\n,"B, C",222222222,\n')
    got = sorted(tuple(r) for r in load_districts(spark, d, keep=("sfa_name", "aun", "schl_type"), id_col="aun").collect())
    assert got == [("B, C", "222222222", None), ("District A", "111111111", "Public")]
    write(str(tmp_path / "open"), "mds.csv", 'a\nb\nc\n"AUN,SFA Name\n1,2\n')
    with pytest.raises(ValueError, match="not closed"):
        load_districts(spark, str(tmp_path / "open"))


@pytest.mark.parametrize("renames", [0, 1, 2])
def test_a_publication_that_stops_in_between_loses_nothing(spark, tmp_path, monkeypatch, renames):
    from rollmatch.sources import snapshot

    path = str(tmp_path / "snap")
    snapshot.replace_snapshot(spark.range(3), path)
    real = snapshot._file_system

    class Stopping:
        """A file system whose job is lost after ``renames`` renames."""
        def __init__(self, fs):
            self.fs, self.left = fs, renames

        def rename(self, a, b):
            if not self.left:
                raise RuntimeError("lost")
            self.left -= 1
            return self.fs.rename(a, b)

        def delete(self, *args):
            if not self.left:
                raise RuntimeError("lost")
            return self.fs.delete(*args)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    def stopping(spark, path):
        fs, at = real(spark, path)
        return Stopping(fs), at

    monkeypatch.setattr(snapshot, "_file_system", stopping)
    with pytest.raises(RuntimeError, match="lost"):
        snapshot.replace_snapshot(spark.range(5), path)
    monkeypatch.setattr(snapshot, "_file_system", real)
    assert snapshot.read_snapshot(spark, path).count() == (5 if renames == 2 else 3)
    # the next publication may read what stands and completes
    again = snapshot.replace_snapshot(snapshot.read_snapshot(spark, path).union(spark.range(1)), path)
    assert again.count() == (6 if renames == 2 else 4) and snapshot.read_snapshot(spark, path).count() == again.count()
