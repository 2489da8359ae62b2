"""Write PLANS.md: the physical plan shape of every registered query.

python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pipewright import get_spark, registry  # noqa: E402

FLAGSHIP = "pipeline_outcome"


def shape(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": plan.count("FileScan parquet"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "window_limit": "WindowGroupLimit" in plan,
        "python": any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython")),
        "nested_loop": "NestedLoopJoin" in plan or "CartesianProduct" in plan,
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 8)
    rows = []
    flagship_plan = ""
    for name, job in registry.queries().items():
        df = job(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, shape(plan)))
        if name == FLAGSHIP:
            flagship_plan = df._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    out = ["# Physical plans", "",
           f"Generated by `python tools/plans.py` at `{os.path.basename(sf)}` on local[8] (before AQE re-planning;",
           "AQE may turn a sort-merge join into a broadcast join at runtime when it measures a small side).", "",
           "| query | shuffles | broadcasts | parquet scans | sort-merge joins | broadcast joins | map-side top-N |"
           " Python | nested loop |",
           "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, s in rows:
        out.append(f"| `{name}` | {s['shuffles']} | {s['broadcasts']} | {s['scans']} | {s['smj']} | {s['bhj']} | "
                   f"{'yes' if s['window_limit'] else ''} | {'YES' if s['python'] else 'no'} | "
                   f"{'YES' if s['nested_loop'] else 'no'} |")
    out += ["", f"## `{FLAGSHIP}` (formatted)", "", "```", flagship_plan.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
