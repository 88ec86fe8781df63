"""Headline queries: wall time of the best of two runs after one warm-up, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from clickloom.plans.catalog import QUERIES
from clickloom.session import configure

HEADLINE = (
    "p12_staged_projection",
    "a7_distinct_rows",
    "a8_exact_duplicates",
    "a1_session_facts",
    "a1_session_events",
    "w1_previous_event",
    "a5_conversion_dedupe",
    "j1_fact_attribution",
    "j3_fact_attribution_b",
    "q8_dq_report",
    "r0_contract_violations",
    "m10_status_per_day",
    "m12_monitor_alerts",
    "tz_validation_summary",
    "d2_channel_mix",
    "n2_conversion_rates",
    "n3_attribution_coverage",
    "st6_abandoned_carts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("clickloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    total = round(sum(seconds.values()), 3)
    line = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
