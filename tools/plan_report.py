"""Write PLANS.md: the physical plan shape of every stage table.

    python tools/plan_report.py [sf_dir]

For each stage, the plan Spark builds before runtime adaptation (static
broadcasts are disabled in pavespark sessions, so this is the plan a large
cluster starts from). Listed are the join strategies, the shuffle keys of
every exchange, the window partition keys and the forbidden operators.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from pavespark.plans.stages import SurveyStages  # noqa: E402
from pavespark.session import get_spark  # noqa: E402

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def clean(expr: str) -> str:
    expr = re.sub(r"#\d+L?", "", expr)
    return re.sub(r"\s+", " ", expr)


def summarize(plan: str) -> dict:
    joins = Counter(re.findall(r"\b(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)\b", plan))
    exchanges = Counter(clean(m) for m in re.findall(
        r"Exchange (hashpartitioning\([^\n]*?\)|rangepartitioning\([^\n]*?\)|SinglePartition)",
        plan))
    windows = Counter(clean(m) for m in re.findall(
        r"Window \[.*?\], \[([^\]]*)\]", plan))
    return {"joins": dict(joins), "exchanges": exchanges, "windows": windows,
            "forbidden": [f for f in FORBIDDEN if f in plan],
            "generate": plan.count("Generate ")}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 16)
    p = SurveyStages.from_fixtures(spark, sf, record_plans=True)
    out = ["# PLANS — physical plan shape of every stage table", "",
           f"Generated by `python tools/plan_report.py {sf}`: the plan Spark builds before "
           "runtime adaptation (static broadcasts disabled), so joins appear as sort-merge "
           "joins; AQE turns the small sides into broadcasts at runtime from measured sizes.", ""]
    for name, get in bench.STAGES:
        n0 = len(p.plans)
        get(p)
        for i, plan in enumerate(p.plans[n0:]):
            s = summarize(plan)
            title = name if i == 0 else f"{name} (internal step {i})"
            out.append(f"## {title}")
            out.append("")
            out.append(f"* joins: {s['joins'] or 'none'}; interval/halo explodes: {s['generate']}")
            out.append(f"* forbidden operators: {s['forbidden'] or 'none'}")
            out.append("* exchanges (shuffle keys, count):")
            for k, v in sorted(s["exchanges"].items()):
                out.append(f"  * `{k[:160]}` ×{v}")
            if s["windows"]:
                out.append("* window partitions:")
                for k, v in sorted(s["windows"].items()):
                    out.append(f"  * `{k[:160]}` ×{v}")
            out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out) + "\n")
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
