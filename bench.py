"""Benchmark: every registered SQL-backed key, warm, median of three runs.

Each query is executed in full with the ``noop`` sink (no collect to the
driver). Prints one JSON line:
{"metric": "sum_median_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_ONLY (comma-separated keys).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_ONLY", "").split(",") if k]

    from ledgerscope.plans.registry import REGISTRY
    from ledgerscope.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    t_setup = time.time()
    for key, entry in REGISTRY.items():
        if not entry.bench or not entry.sql or (only and key not in only):
            continue
        try:
            entry.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                entry.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[key] = round(statistics.median(samples), 4)
        except Exception as e:  # noqa: BLE001 - report and continue
            failed[key] = re.sub(r"\s+", " ", str(e))[:200]
    out = {
        "metric": "sum_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": re.sub(r".*sf", "", sf_dir.rstrip("/")),
        "runs": runs,
        "cpus": cpus,
        "wall_sec": round(time.time() - t_setup, 1),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
