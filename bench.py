"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is forced with a ``noop`` write (full computation, nothing
collected to the driver).  Queries that write sinks include their writes.
The landing zone the CSV queries read is written once before timing starts
(it stands in for files that already exist), and its write time is reported
separately as ``landing_setup``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "enriched_sales",
    "sales_incentive_mart",
    "customer_monthly_mart",
    "sales_rank",
    "customer_monthly_window",
    "unmatched_sales",
    "partitioned_mart",
    "csv_ingest_unified",
    "end_to_end_run",
    "stream_file_ingest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tillmart.plans.catalog import QUERIES
    from tillmart.session import build_session
    from tillmart.sources.landing_fixture import landing_for

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = [n for n in HEADLINE if n in QUERIES]
    t0 = time.time()
    landing_for(spark, sf_dir)
    setup = time.time() - t0
    times: dict[str, float] = {}
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "landing_setup": round(setup, 3),
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
