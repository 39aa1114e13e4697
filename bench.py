"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (timed passes, best is kept; default 1).
Each query is run to completion through the ``noop`` sink (full execution,
nothing collected), after one warm-up pass that JIT-compiles the JVM paths.
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_benefits_employee_year",
    "silver_employees_enriched",
    "cdc_parse_envelopes",
    "cdc_latest_per_key",
    "cdc_merge_state",
    "stream_incremental_merge",
    "quality_scan",
    "quality_failed_rows",
    "notify_messages",
    "pipeline_end_to_end",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("strivelake-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from strivelake.plans.catalog import QUERIES

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in HEADLINE:  # warm-up
        run(name)
    times = {name: min(run(name) for _ in range(repeat)) for name in HEADLINE}
    sf = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf_val,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
