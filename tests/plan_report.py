"""Physical-plan summary of every registered query, planned as on a large
cluster: automatic (size-based) broadcasts are switched off, so only the
explicit hints on fixed-size lookups remain, and AQE is off so the static plan
is shown. Writes a markdown table to stdout.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    def n(pat):
        return len(re.findall(pat, plan))
    lines = plan.splitlines()
    fresh = [ln for ln in lines if "ReusedExchange" not in ln]
    shuffles = sum(1 for ln in fresh if re.search(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", ln))
    return {
        "shuffles": shuffles,
        "reused": sum(1 for ln in lines if "ReusedExchange" in ln),
        "spread": sum(1 for ln in fresh if "RoundRobinPartitioning" in ln),
        "broadcasts": n(r"BroadcastExchange"),
        "smj": n(r"SortMergeJoin"), "bhj": n(r"BroadcastHashJoin"),
        "windows": n(r"\bWindow \["), "partial_limits": n(r"WindowGroupLimit .*Partial"),
        "nested_loop": n(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "python": n(r"PythonUDF|ArrowEvalPython|BatchEvalPython"),
    }


def main():
    from arspark import registry
    from arspark.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                 "spark.sql.adaptive.enabled": "false"})
    print("| query | shuffles | reused shuffles | spread after scan | broadcasts (hinted) | sort-merge joins |"
          " broadcast joins | windows | partial group limits | nested-loop | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(registry.BUILDERS):
        df = registry.run(name, spark, sf)
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['spread']} | {s['broadcasts']} | {s['smj']} |"
              f" {s['bhj']} | {s['windows']} | {s['partial_limits']} | {s['nested_loop']} | {s['python']} |")


if __name__ == "__main__":
    main()
