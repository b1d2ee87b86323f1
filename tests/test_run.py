"""The command line end to end: CSV folders -> intake -> combine -> reports; consolidation."""

import os

from rollmatch.plans.consolidate import LAYOUT
from rollmatch.plans.run import main
from tests.test_sources import HEADER, line, row25, write


def test_command_line_jobs(spark, tmp_path):
    t = str(tmp_path)
    write(f"{t}/in/s/b1", "a.csv", HEADER + "\n" + line(row25(school_code4="1")) + "\n")
    write(f"{t}/in/s/b2", "b.csv", HEADER + "\n" + line(row25(student_first_name="Bo", aun9_3="222222222")) + "\n")
    write(f"{t}/in/p", "p.csv", HEADER + "\n" + line(row25(school_code4="2")) + "\n"
          + line(row25(student_first_name="Bo", aun9_3="222-22-222-2")) + "\n")
    write(f"{t}/in/dc", "x111111111_meals.csv", HEADER + "\n" + line(row25()) + "\n")
    write(f"{t}/in/mds", "mds.csv", "a\nb\nc\nAUN,SFA Name,AUN,Schl Type\n,District A,111111111,Public\n")
    main(["intake", "--side", "s", "--folder", f"{t}/in/s/b1", "--out", f"{t}/snap/s1"])
    main(["intake", "--side", "s", "--folder", f"{t}/in/s/b2", "--out", f"{t}/snap/s2"])
    main(["intake", "--side", "p", "--folder", f"{t}/in/p", "--out", f"{t}/snap/p"])
    main(["combine", "--side", "s", "--batch", f"b1={t}/snap/s1", "--batch", f"b2={t}/snap/s2",
          "--out", f"{t}/snap/s_all"])
    # the undashed id of batch 2 fails the district id check and is dropped
    assert spark.read.parquet(f"{t}/snap/s_all").count() == 1
    main(["reports", "--s", f"{t}/snap/s_all", "--p", f"{t}/snap/p", "--districts", f"{t}/in/mds",
          "--out", f"{t}/out", "--format", "csv"])
    summ = spark.read.option("header", True).csv(f"{t}/out/summary").collect()
    by_aun = {r["AUN"]: r for r in summ}
    assert by_aun["111111111"]["school_code_mismatch_count"] == "1"
    assert by_aun["111111111"]["sfa_name"] == "District A"
    assert by_aun["222222222"]["p_total"] == "1"
    main(["reports", "--s", f"{t}/snap/s_all", "--p", f"{t}/snap/p", "--districts", f"{t}/in/mds",
          "--out", f"{t}/out_raw", "--raw"])
    assert os.path.isdir(f"{t}/out_raw/cs_site_code_mismatches")
    main(["consolidate", "--folder", f"{t}/in/dc", "--pattern", "meal", "--full", f"{t}/snap/p",
          "--out", f"{t}/wide"])
    wide = spark.read.option("header", True).csv(f"{t}/wide").collect()
    assert wide[0].asDict().keys() == dict.fromkeys(LAYOUT).keys()
    assert sorted(r["usertype"] for r in wide) == ["DC only", "Full User", "Full User"]
    assert [r["AUN"] for r in wide if r["usertype"] == "DC only"] == ["111-11-111-1"]


def test_raw_reports_include_summary(spark, tmp_path):
    t = str(tmp_path)
    write(f"{t}/in/s", "a.csv", HEADER + "\n" + line(row25(school_code4="1")) + "\n" + line(row25(school_code4="3")) + "\n")
    write(f"{t}/in/p", "p.csv", HEADER + "\n" + line(row25(school_code4="2")) + "\n")
    write(f"{t}/in/mds", "mds.csv", "a\nb\nc\nAUN,SFA Name,AUN,Schl Type\n,District A,111111111,Public\n")
    main(["intake", "--side", "s", "--folder", f"{t}/in/s", "--out", f"{t}/snap/s"])
    main(["intake", "--side", "p", "--folder", f"{t}/in/p", "--out", f"{t}/snap/p"])
    main(["reports", "--s", f"{t}/snap/s", "--p", f"{t}/snap/p", "--districts", f"{t}/in/mds",
          "--out", f"{t}/out_raw", "--raw", "--format", "csv"])
    summ = spark.read.option("header", True).csv(f"{t}/out_raw/summary").collect()
    assert len(summ) == 1
    assert (summ[0]["matched"], summ[0]["school_code_mismatch_count"], summ[0]["s_total"]) == ("2", "2", "2")
    assert "address_mismatch_count" not in summ[0].asDict()
