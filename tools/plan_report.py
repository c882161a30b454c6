"""Final (adaptive) physical plan shape of every registered query, as a Markdown table.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is collected once so the adaptive plan is final, then its nodes
are counted: shuffles, broadcasts, windows, single-partition exchanges,
file scans, reused stages, Python evaluation (must be zero).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_section(plan: str) -> str:
    """The final adaptive plan only (the string also carries the initial plan)."""
    return plan.split("== Initial Plan ==")[0]


def shape(plan: str) -> dict[str, int]:
    plan = final_section(plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "single_partition": plan.count("Exchange SinglePartition"),
        "scans": plan.count("FileScan") + plan.count("Scan ExistingRDD") + plan.count("InMemoryTableScan"),
        "reused": plan.count("ReusedExchange") + plan.count("ReusedQueryStage"),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsIn|MapInPandas|MapInArrow", plan)),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from fundspark.session import build_session

    from fundspark.plans import catalog
    from fundspark.session import checkpoint_dir

    spark = build_session("local[8]", 8, "fundspark-plans")
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="fundspark-plans-", dir="/tmp"))
    cols = ["shuffles", "broadcasts", "windows", "group_limits", "single_partition", "scans", "reused", "python"]
    print(f"# Final plan shape per query ({os.path.basename(sf)}, local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`. Counts are physical-plan nodes after adaptive")
    print("re-planning; `single_partition` only ever sits on one row per date or a one-row total.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
