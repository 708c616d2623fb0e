"""Summarise the physical plan of every registered batch query.

Prints, per query: shuffles (hash/range exchanges), single-partition
exchanges, broadcast hash joins, sort-merge joins, nested-loop joins, sort
aggregates, window operators, Python evaluation nodes, and the columns each
scan reads.  Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTERS = {
    "shuffle": ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobin"),
    "single": ("SinglePartition",),
    "bcast_join": ("BroadcastHashJoin",),
    "smj": ("SortMergeJoin",),
    "nl_join": ("BroadcastNestedLoopJoin", "CartesianProduct"),
    "sort_agg": ("SortAggregate",),
    "window": ("Window [",),
    "python": ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"),
    "scans": ("FileScan",),
}


def summarise(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {k: sum(plan.count(p) for p in pats) for k, pats in COUNTERS.items()}
    out["reads"] = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
    return out


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from bellwether.plans.queries import registry
    from bellwether.session import get_session

    spark = get_session("local[8]", shuffle_partitions=8)
    keys = list(COUNTERS)
    print("| query | " + " | ".join(keys) + " | scan columns |")
    print("| --- | " + " | ".join("---" for _ in keys) + " | --- |")
    for name, fn in registry().items():
        if name.startswith("stream_"):
            continue
        s = summarise(fn(spark, sf))
        reads = "; ".join(r.replace(",", ", ") for r in s["reads"])
        print(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + f" | {reads} |")


if __name__ == "__main__":
    main(sys.argv)
