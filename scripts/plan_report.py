"""Print plan statistics (and optionally the formatted plan) per query.

Usage: python scripts/plan_report.py [sf_dir] [--no-broadcast] [--show name ...]

``--no-broadcast`` turns Spark's size thresholds off, so the plans look as
they would at scale, where no input fits under them.
Counts shuffle exchanges, broadcast exchanges, sort-merge / broadcast joins,
WindowGroupLimit nodes, Python evaluation nodes and cartesian products in the
*executed* (post-AQE) plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.catalog import QUERIES  # noqa: E402
from tillroll.session import local_session  # noqa: E402

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "single": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "wgl": r"WindowGroupLimit",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
    "reused": r"ReusedExchange|ReusedQueryStage",
    "sortagg": r"SortAggregate",
}


def executed_plan(df) -> str:
    df.collect()  # executes this query execution, so AQE finalises its plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]  # the final (AQE) plan only


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    args = [a for a in args if a != sf_dir]
    show = args[args.index("--show") + 1:] if "--show" in args else []
    spark = local_session(8)
    if "--no-broadcast" in args:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for name, fn in QUERIES.items():
        if name.startswith(("csv_", "sink_")) or name.endswith("_shared"):
            continue
        df = fn(spark, sf_dir)
        plan = executed_plan(df)
        counts = {k: len(re.findall(v, plan)) for k, v in PATTERNS.items()}
        print(f"{name:28s} " + " ".join(f"{k}={v}" for k, v in counts.items()))
        if name in show:
            df.explain("formatted")
            print(plan)
    spark.stop()


if __name__ == "__main__":
    main()
