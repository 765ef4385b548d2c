"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.  Each query
is fully computed through the ``noop`` sink (no collect to the driver); a
warm-up query runs first so JVM start-up is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["weekly_features", "psi_all_features", "psi_by_class", "reference_bins", "kruskal_h",
            "split_compositional", "report_by_slice", "drift_alarms", "box_summary", "stream_weekly"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from wakeline.plans.catalog import QUERIES
    from wakeline.session import get_session
    spark = get_session(f"local[{cpus}]", max(cpus, 8), app_name="wakeline-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    QUERIES["class_balance"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
