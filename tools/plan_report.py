"""Summarise the executed (final, adaptive) physical plan of every query.

usage: python tools/plan_report.py [sf_dir] > PLANS.md

Per query: the columns each Parquet scan reads and the filters pushed to
it, the join strategies, the number of shuffles, whether any Python
evaluation is in the plan, and the number of whole-stage-codegen stages."""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOINS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct"]


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[([^\]]*)\]"
                         r".*?PushedFilters: \[([^\]]*)\], ReadSchema: (struct<[^>]*>)", plan):
        table = os.path.basename(m.group(3).rstrip("/").split(",")[0]).replace(".parquet", "")
        scans.append((table, m.group(5), m.group(4)))
    joins = {j: len(re.findall(rf"\b{j}\b", plan)) for j in JOINS}
    return {
        "scans": sorted(set(scans)),
        "joins": {k: v for k, v in joins.items() if v},
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                                   plan)),
        "python": bool(re.search(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }


def main() -> None:
    from signalyard.session import build_session
    from signalyard.plans.jobs import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    print("# PLANS\n")
    print(f"Executed physical plans (final adaptive plans) of every registered query at `{sf}`, "
          "generated by `tools/plan_report.py`. *scans*: table, columns read (`ReadSchema`) and "
          "filters pushed into the Parquet reader. Streaming queries show their batch read-back. "
          "Counts are textual: the plans of persisted relations and scalar subqueries are printed "
          "(and counted) where they are used, although each executes once.\n")
    for name, fn in QUERIES.items():
        t0 = time.time()
        df = fn(spark, sf)
        df.collect()  # execute this DataFrame's own plan (small sf: a dev tool)
        qe = df._jdf.queryExecution()
        plan = qe.executedPlan()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan = plan.executedPlan()  # the final adaptive plan only
        s = summarise(plan.toString())
        print(f"## `{name}`\n")
        print(f"- joins: {s['joins'] or 'none'}; shuffles: {s['shuffles']}; "
              f"codegen stages: {s['codegen_stages']}; python in plan: {s['python']}; "
              f"{time.time() - t0:.1f}s")
        for table, schema, pushed in s["scans"]:
            print(f"- scan `{table}` reads `{schema}`" + (f", pushed `{pushed}`" if pushed else ""))
        print()


if __name__ == "__main__":
    main()
