"""Command line: the three jobs the original scripts are run for.

  python -m rollmatch.plans.run intake  --side s --folder IN/batch6 --out SNAP/s_batch6 [--lenient]
  python -m rollmatch.plans.run combine --side s --batch b1=SNAP/s_b1 --batch b2=SNAP/s_b2 --out SNAP/s_all
  python -m rollmatch.plans.run reports --s SNAP/s_all --p SNAP/p --districts MDS.csv --out OUT [--raw]
  python -m rollmatch.plans.run consolidate --folder IN/dc_only --pattern meal --full SNAP/p --out OUT.csv

Runs against the session ``spark-submit`` provides (cluster settings, checkpoint folder).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rollmatch.functions.aun import MEAL_FILE_AUN, UPLOAD_FILE_AUN
from rollmatch.operators.dimension import prepare_dimension
from rollmatch.plans.consolidate import consolidate_folder
from rollmatch.plans.intake import combine_batches, intake_batch
from rollmatch.plans.reconcile import reconcile
from rollmatch.plans.reports import write_reports
from rollmatch.schema import MEAL, STUDENT
from rollmatch.sources.csv import ORDER
from rollmatch.sources.districts import load_districts
from rollmatch.sources.snapshot import read_snapshot
from rollmatch.sources.export import export_csv

SIDES = {"s": STUDENT, "p": MEAL}
PATTERNS = {"upload": UPLOAD_FILE_AUN, "meal": MEAL_FILE_AUN}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="rollmatch")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("intake")
    a.add_argument("--side", choices=SIDES, required=True)
    a.add_argument("--folder", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--lenient", action="store_true")
    a.add_argument("--blank", choices=("empty", "null"), default="empty")
    a.add_argument("--encoding", default="UTF-8")
    c = sub.add_parser("combine")
    c.add_argument("--side", choices=SIDES, required=True)
    c.add_argument("--batch", action="append", required=True, help="name=snapshot path")
    c.add_argument("--out", required=True)
    r = sub.add_parser("reports")
    r.add_argument("--s", required=True)
    r.add_argument("--p", required=True)
    r.add_argument("--districts", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--policy", choices=("name_dob", "by_id_length"), default="name_dob")
    r.add_argument("--parent-mode", choices=("or", "and"), default="or")
    r.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    r.add_argument("--raw", action="store_true", help="measures over the raw many-to-many match")
    r.add_argument("--normalize-aun", action="store_true")
    k = sub.add_parser("consolidate")
    k.add_argument("--folder", required=True)
    k.add_argument("--pattern", choices=PATTERNS, required=True)
    k.add_argument("--full", required=True, help="Full User intake snapshot")
    k.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"rollmatch-{args.cmd}").getOrCreate()
    if args.cmd == "intake":
        intake_batch(spark, args.folder, SIDES[args.side], args.out,
                     mode="lenient" if args.lenient else "strict", blank=args.blank, encoding=args.encoding)
    elif args.cmd == "combine":
        batches = dict(b.split("=", 1) for b in args.batch)
        combine_batches(spark, batches, SIDES[args.side], args.out)
    elif args.cmd == "reports":
        dim = prepare_dimension(load_districts(spark, args.districts))
        s_rows, p_rows = read_snapshot(spark, args.s), read_snapshot(spark, args.p)
        rec = reconcile(s_rows, p_rows, dim, args.policy, prepared=True, normalize_aun=args.normalize_aun,
                        order=ORDER, parent_mode=args.parent_mode)
        write_reports(rec, args.out, args.format, dedup=not args.raw)
    elif args.cmd == "consolidate":
        export_csv(consolidate_folder(spark, args.folder, PATTERNS[args.pattern], read_snapshot(spark, args.full)),
                   args.out)


if __name__ == "__main__":
    main()
