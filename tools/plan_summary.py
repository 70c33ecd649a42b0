"""Summarise the executed physical plan of every registered key (regenerates PLANS.md's table).

usage: python tools/plan_summary.py [--sf DIR] [key-prefix ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    return {
        "exchanges": sum(plan.count(f"Exchange {p}") for p in ("hashpartitioning", "rangepartitioning", "SinglePartition")),
        "sort-merge": plan.count("SortMergeJoin"),
        "broadcast-hash": plan.count("BroadcastHashJoin"),
        "nested-loop": plan.count("NestedLoopJoin") + plan.count("CartesianProduct"),
        "windows": plan.count("Window ["),
        "python": plan.count("Python") + plan.count("ArrowEval"),
        "scans": len(scans),
        "max cols": max((len(s.split(",")) for s in scans), default=0),
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from vitalis.session import local_session
    from vitalis.plans import registry

    spark = local_session()
    qs = registry.queries()
    cols = None
    for k in sorted(qs):
        if a.keys and not any(k.startswith(p) for p in a.keys):
            continue
        row = summarise(qs[k](spark, a.sf)._jdf.queryExecution().executedPlan().toString())
        if cols is None:
            cols = list(row)
            print("| key | " + " | ".join(cols) + " |")
            print("| --- " * (len(cols) + 1) + "|")
        print(f"| {k} | " + " | ".join(str(row[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
