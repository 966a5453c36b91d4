"""Summarise the physical plan of every driver query into PLANS.md.

For each query: shuffles (Exchange), join strategies, aggregates, Python
evaluation nodes, whole-stage codegen spans, and the scans' read schema and
pushed filters. Usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelhouse.plans.queries import QUERIES  # noqa: E402
from reelhouse.session import local_session  # noqa: E402

NODES = ["Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
         "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "Window", "Generate", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def summarise(plan: str) -> dict:
    tree = plan.split("\n\n")[0]
    counts = {n: len(re.findall(rf"(?<![A-Za-z]){n} ", tree + " ")) for n in NODES}
    reads = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)
    pushed = [p for p in re.findall(r"PushedFilters: (\[[^\n]*\])", plan) if p != "[]"]
    parts = re.findall(r"PartitionFilters: (\[[^\n]*\])", plan)
    return {"counts": {k: v for k, v in counts.items() if v}, "reads": reads, "pushed": pushed,
            "partition_filters": [p for p in parts if p != "[]"]}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = local_session()
    lines = ["# Physical plans of the driver queries", "",
             f"Generated by `tools/plan_report.py` on `{sf}` (local mode; AQE may re-plan at run time).",
             "Columns: shuffles and operators in the final plan; scan read schemas; pushed filters.", "",
             "| query | operators | scans (ReadSchema) | pushed / partition filters |", "| --- | --- | --- | --- |"]
    for name, q in QUERIES.items():
        df = q(spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        s = summarise(plan)
        ops = ", ".join(f"{k}×{v}" for k, v in s["counts"].items()) or "scan + project only"
        reads = "<br>".join(f"`{r[:110]}{'…' if len(r) > 110 else ''}`" for r in s["reads"][:4])
        filt = "<br>".join(f"`{p[:90]}`" for p in (s["pushed"] + s["partition_filters"])[:3])
        lines.append(f"| {name} | {ops} | {reads} | {filt} |")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main()
