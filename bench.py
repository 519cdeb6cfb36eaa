"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each query runs to completion through a no-op sink (nothing is collected to the
driver); the time is the best of ``BENCH_REPEAT`` runs after one warm-up run
that also writes the snapshot landing tree once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans import catalog  # noqa: E402
from starmart.session import build_session  # noqa: E402

HEADLINE = (
    "history_latest_run",
    "load_all",
    "load_missing",
    "dim_merge_incremental",
    "fact1_headcount",
    "fact2_org_count",
    "employee_detail",
    "fact1_end_to_end",
    "publish_all",
)


def run(spark, name: str, sf: str) -> float:
    q = catalog.queries()[name]
    t0 = time.perf_counter()
    q(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    run(spark, "load_all", sf)  # warm-up; writes the landing tree if missing
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run(spark, name, sf) for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)$", sf)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf,
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
