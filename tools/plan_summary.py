"""Summarise the physical plans of the headline queries (after AQE) as markdown.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ("Scan parquet", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "Exchange RoundRobinPartitioning", "ReusedExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "SortAggregate",
       "ObjectHashAggregate", "Window ", "WindowGroupLimit", "Expand", "Generate", "TakeOrderedAndProject",
       "ArrowEvalPython", "MapInPandas", "BatchEvalPython")


def summarise(plan: str) -> str:
    counts = Counter()
    for op in OPS:
        n = plan.count(op)
        if n:
            counts[op.strip()] = n
    keys = sorted(set(re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+", plan)))
    keys = [re.sub(r"#\d+L?", "", k) for k in keys]
    ops = ", ".join(f"{k} x{v}" for k, v in counts.items())
    return ops + ("; shuffle keys: " + "; ".join(f"({k})" for k in keys) if keys else "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from capsight.plans.queries import QUERIES
    from capsight.session import local_session
    spark = local_session()
    print(f"# Physical plans of the headline jobs ({os.path.basename(sf_dir)}, after AQE)\n")
    print("Generated by `tools/plan_summary.py`. Operator counts of the final executed plan.\n")
    print("| Query | Operators |\n| --- | --- |")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| `{name}` | {summarise(plan)} |")


if __name__ == "__main__":
    main()
