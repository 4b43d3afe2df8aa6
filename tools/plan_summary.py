"""Write PLANS.md: per registered query, the physical-plan facts that matter at scale.

For each query: columns read per scan (``ReadSchema``), pushed filters, shuffle
exchanges (and their partitioning), joins (broadcast or not), aggregates, and
whether any Python runs in the plan.  Usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = {"random_search", "gbt_scores", "stream_score", "stream_latency", "stream_requests", "job_tuning"}  # ML fits / drained streams


def summarize(plan: str) -> dict:
    scans = re.findall(r"ReadSchema: struct<(.*)>\s*$", plan, flags=re.M)
    pushed = [p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p]
    exch = re.findall(r"Arguments: (hashpartitioning|RoundRobinPartitioning|SinglePartition|rangepartitioning)", plan)
    joins = re.findall(r"\((\d+)\) (BroadcastHashJoin|SortMergeJoin|BroadcastNestedLoopJoin|CartesianProduct|ShuffledHashJoin)", plan)
    aggs = len(re.findall(r"\) HashAggregate|\) ObjectHashAggregate|\) SortAggregate", plan))
    python = bool(re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan))
    return {"scans": [len(re.findall(r"(?:^|,)\w+:", s)) for s in scans], "pushed": pushed, "exchanges": exch,
            "joins": [j[1] for j in joins], "aggregates": aggs, "python": python}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from sparktab.plans import catalog
    from sparktab.session import get_spark

    spark = get_spark("local[8]", shuffle_partitions=8)
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `tools/plan_summary.py` at `{sf}` (AQE on; plans before runtime re-optimisation).",
             "Scans list the number of columns read; `RoundRobin` exchanges come from `spread()` "
             "(single-row-group test files only).", "",
             "| query | columns read per scan | pushed filters | exchanges | joins | aggregates | Python |",
             "|---|---|---|---|---|---|---|"]
    for name, fn in catalog.queries().items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        s = summarize(plan)
        ex = {}
        for e in s["exchanges"]:
            ex[e] = ex.get(e, 0) + 1
        lines.append(f"| {name} | {s['scans']} | {'; '.join(s['pushed']) or '-'} | "
                     f"{', '.join(f'{k}×{v}' for k, v in ex.items()) or '-'} | {', '.join(s['joins']) or '-'} | "
                     f"{s['aggregates']} | {'yes' if s['python'] else 'no'} |")
    lines += ["", "Not listed: " + ", ".join(sorted(SKIP)) + " (model fits run many jobs; streams are drained "
              "to a Parquet sink and read back)."]
    review = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scale_review.md")
    if os.path.exists(review):
        lines.append(open(review).read().rstrip())
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
