"""Benchmark the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).  Each query is built fresh per run, forced in full
with the ``noop`` sink (not ``count()``, which could prune columns), after
a warm-up pass over all queries; the reported time is the median.  Caches are cleared
between runs so a run never reads the previous run's persisted ranks.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelbeam.plans.queries import QUERIES  # noqa: E402
from parcelbeam.session import build_session  # noqa: E402

HEADLINE = [
    "ratio_town_stats",
    "ratio_deciles",
    "value_change_flags",
    "documents_per_unit",
    "unit_review_sheet",
]
EXTRA = [
    "ratio_all_parcels",
    "neighborhood_medians_long",
    "building_joined_rows",
    "condo_join_chain",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="parcelbeam-bench")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    timings: dict[str, float] = {}
    for name in HEADLINE + EXTRA:  # warm-up pass: JIT and file footers, not counted
        run_once(spark, name, sf_dir)
    for name in HEADLINE + EXTRA:
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_median_total",
        "value": round(sum(timings[q] for q in HEADLINE), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "config": {"master": f"local[{cpus}]", "shuffle_partitions": cpus, "runs": runs,
                   "spark": spark.version, "sink": "noop"},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
