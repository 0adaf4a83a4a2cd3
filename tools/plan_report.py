"""Summarise the executed physical plans of the headline queries.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Runs each query once (collect, at a small scale) so its adaptive plan is final, then counts
the operators that matter for scale: scans and their read schema, join
strategies, exchanges, whole-stage-codegen stages and any Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402


def summarize(plan: str) -> dict:
    ops = Counter()
    for pat, name in [(r"BroadcastHashJoin", "broadcast hash join"),
                      (r"SortMergeJoin", "sort-merge join"),
                      (r"BroadcastNestedLoopJoin", "nested-loop join"),
                      (r"CartesianProduct", "cartesian product"),
                      (r"Exchange hashpartitioning", "hash exchange"),
                      (r"Exchange rangepartitioning", "range exchange"),
                      (r"Exchange SinglePartition", "single-partition exchange"),
                      (r"WindowGroupLimit", "window group limit"),
                      (r"\bWindow \[", "window"),
                      (r"HashAggregate", "hash aggregate"),
                      (r"ObjectHashAggregate", "object hash aggregate"),
                      (r"WholeStageCodegen|\*\(\d+\)", "codegen operator"),
                      (r"BatchEvalPython|ArrowEvalPython|PythonUDF", "python evaluation")]:
        ops[name] = len(re.findall(pat, plan))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {"ops": {k: v for k, v in ops.items() if v}, "schemas": schemas}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from binscope import catalog
    from binscope.session import local_session
    spark = local_session(8)
    print(f"# Executed plans of the headline queries ({os.path.basename(sf)})\n")
    print("Generated by `tools/plan_report.py`; counts are over the final adaptive plan.\n")
    for name in HEADLINE:
        df = catalog.QUERIES[name](spark, sf)
        df.collect()  # executes this DataFrame's own adaptive plan to its final form
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        s = summarize(plan)
        print(f"## {name}\n")
        print("| operator | count |\n| --- | --- |")
        for k, v in s["ops"].items():
            print(f"| {k} | {v} |")
        print("\nScans read only:\n")
        for sch in s["schemas"]:
            print(f"- `{sch}`")
        print()
    spark.stop()


if __name__ == "__main__":
    main()
