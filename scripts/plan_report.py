"""Markdown table of each registered query's physical plan: shuffles, broadcasts, Python.

usage: python scripts/plan_report.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from rollmatch.plans.catalog import QUERIES  # noqa: E402
from rollmatch.session import local_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    spark = local_session(8)
    print("| query | hash shuffles | range shuffles | broadcasts | partial aggregation / limit | Python |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        plan = q(spark, a.sf).select("*")._jdf.queryExecution().executedPlan().toString()
        hashed = len(re.findall(r"Exchange hashpartitioning", plan))
        ranged = len(re.findall(r"Exchange rangepartitioning|Exchange SinglePartition", plan))
        bcast = len(re.findall(r"BroadcastExchange", plan))
        partial = "yes" if re.search(r"partial_|WindowGroupLimit.*Partial", plan) else "-"
        py = "Arrow UDF" if "ArrowEvalPython" in plan else ("mapInPandas" if "MapInPandas" in plan else "-")
        print(f"| `{name}` | {hashed} | {ranged} | {bcast} | {partial} | {py} |")


if __name__ == "__main__":
    main()
