"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written to Spark's noop sink (all rows and columns are computed):
one warm-up run, then the median of three (one run for queries that write files and
tables). Table plans built by the warm-up are reused by the later runs; no data is cached.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.registry import QUERIES
from navrecon.session import build_session

HEADLINE = [
    "cumulative_twrr", "financial_metrics", "recon_report", "recon_summary", "recon_results",
    "performance_summary", "upsert_performance", "portfolio_outliers", "dashboard_metrics",
    "file_details", "quality_rates", "profile_columns", "dq_issues", "recompute_check",
    "metric_windows", "alarm_eval", "alarm_set",
]
# These write files and tables and read them back; one timed run each.
WRITERS = ["load_file", "upsert_on_disk", "stream_log_errors_5m"]
# What a query reads; all others read orders and lineitem.
READS = {name: ("events",) for name in ("metric_windows", "alarm_eval", "alarm_set", "stream_log_errors_5m")}


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + WRITERS
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(spark, folder, name)
        runs = 1 if name in WRITERS else 3
        times[name] = round(statistics.median(seconds(spark, folder, name) for _ in range(runs)), 3)
    rows = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("orders", "lineitem", "events")}
    read = {n: sum(rows[t] for t in READS.get(n, ("orders", "lineitem"))) for n in names}
    print(json.dumps({
        "metric": "total seconds, median of 3 per query", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "rows_read": read,
        "rows_per_sec": {n: round(read[n] / t) for n, t in times.items()}, "spark": spark.version, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
