"""Benchmark the headline queries.

Runs on ``local[$BENCH_CPUS]`` (shuffle partitions: two per core unless
``$BENCH_SHUFFLE_PARTITIONS``) over ``$BENCH_SF_DIR`` (default sf0.1), executes
every query fully through the ``noop`` sink (nothing is collected to the
driver), and prints one JSON line: per-query warm median of ``$BENCH_RUNS``
runs (default 3) after one warm-up, and their sum as the headline value.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candela.plans.catalog import registry  # noqa: E402
from candela.session import local_session  # noqa: E402

HEADLINE = ["technical_indicators", "returns", "investment_summary", "q09", "bars",
            "fundamentals_ranked", "q04", "upsert_update"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # two waves of tasks per core balance uneven ticker partitions
    default_partitions = 2 * int(cpus) if cpus.isdigit() else 16
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS",
                                                                      default_partitions)),
                          app="candela-bench")
    qs = registry()
    timings: dict[str, float] = {}
    for name in names:
        def once() -> float:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up: JVM, code generation, file listing
        timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_warm_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
