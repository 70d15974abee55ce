"""Write PLANS.md: physical plans of the headline queries (as planned, before AQE runtime changes).

usage: python scripts/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.plans.registry import QUERIES  # noqa: E402
from ordermill.session import get_spark  # noqa: E402

HEADLINE = ["daily_metrics", "merge_newer", "merge_change_rows", "merge_null_safe", "dq_report", "quality_gate",
            "latest_run_state"]


def summary(plan: str) -> str:
    keys = ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange", "SortMergeJoin",
            "BroadcastHashJoin", "ShuffledHashJoin", "WindowGroupLimit", "HashAggregate", "SortAggregate",
            "BroadcastNestedLoopJoin", "CartesianProduct"]
    return ", ".join(f"{k}: {plan.count(k)}" for k in keys if plan.count(k))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("ordermill-plans", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = [f"# Physical plans ({os.path.basename(sf)}, local[8]; AQE may re-plan joins at runtime)\n",
           "Generated by `scripts/dump_plans.py`; operator counts first, then the executed plan.\n"]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", plan)
        out.append(f"\n## {name}\n\n{summary(plan)}\n\n```\n{plan.strip()}\n```\n")
    out.append("\n## All registered queries: operator counts\n\n| query | counts |\n| --- | --- |\n")
    for name in sorted(QUERIES):
        if name in {"incremental_run", "replay_run", "event_job", "stream_bronze", "stream_silver", "csv_roundtrip",
                    "stream_order_files"}:
            continue
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        out.append(f"| {name} | {summary(df._jdf.queryExecution().executedPlan().toString())} |\n")
    print("".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
