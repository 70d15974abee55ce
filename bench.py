"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 5), BENCH_QUERIES (comma list, default headline set).
Each query runs once to warm up, then BENCH_REPEAT times into the ``noop`` sink
(full execution, nothing collected); the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermill.plans.registry import QUERIES  # noqa: E402
from ordermill.session import get_spark  # noqa: E402
from ordermill.sources.bronze import write_bronze  # noqa: E402

HEADLINE = [
    "daily_metrics",          # minimum slice: scan -> validate -> latest per key -> daily aggregate
    "merge_newer",            # upsert of the update batch into the silver state
    "merge_null_safe",        # quarantine insert-only merge with null-safe keys
    "dq_report",              # per-file data-quality report with surplus duplicates
    "quality_gate",           # event parse -> latest -> totals -> five checks
    "validate_first_error",   # first-error messages + canonical raw-row JSON
    "latest_per_key_tiebreak",
    "merge_tiebreak",
    "stream_bronze",          # file-stream drain: envelope files -> idempotent bronze sink (incl. re-delivery)
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_spark("ordermill-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    per_query: dict[str, float] = {}
    rows: dict[str, int] = {}
    # bronze ingest: derive the raw order feed + envelope from `orders` and write both tables
    write_bronze(spark, sf)
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        paths = write_bronze(spark, sf)
        times.append(time.perf_counter() - t0)
    per_query["bronze_ingest"] = round(statistics.median(times), 3)
    rows["bronze_ingest"] = spark.read.parquet(paths["raw_orders"]).count()
    for name in names:
        q = QUERIES[name]
        q(spark, sf).write.format("noop").mode("overwrite").save()          # warm-up
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            q(spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        per_query[name] = round(statistics.median(times), 3)
        rows[name] = q(spark, sf).count()
    total = round(sum(per_query.values()), 3)
    print(json.dumps({"metric": "headline_total_median", "value": total, "unit": "sec", "queries": per_query,
                      "rows": rows, "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": cpus,
                      "shuffle_partitions": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
