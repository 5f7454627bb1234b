"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric": ..., "value": total_sec, "unit": "sec",
"queries": {name: median_sec}, "sf": ...}. Each query is fully executed
with the ``noop`` sink (no collect to the driver); one warm-up pass, then the
median of $BENCH_RUNS timed runs. "first_run" holds the warm-up times: that of
``batch_predict`` includes building the features and fitting the forest, which
later runs of a session find done.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "market_profile", "radius_count", "nearest_amenity", "ridership_near", "network_distance",
    "dbscan_roads", "batch_predict", "district_of_road", "geocode_lookup", "fill_district_max",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from plotwise.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    import plotwise.plans as plans
    qs = plans.all_queries()
    names = [k for k in (only or HEADLINE) if k in qs]
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in names:
        def once() -> float:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        try:
            first[name] = round(once(), 3)
            times[name] = round(statistics.median(once() for _ in range(max(runs, 1))), 3)
        except Exception as exc:  # noqa: BLE001 - report and continue
            print(f"bench: {name} failed: {type(exc).__name__}: {str(exc)[:200]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
