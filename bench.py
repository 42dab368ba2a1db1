"""Benchmark: run every registered query at one scale factor, print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is executed in full with the ``noop`` sink (no collect to the
driver); queries that build tables (two-load runs, file ingest) include
their writes. The two-load warehouse is built once, timed as
``two_load_build``; the ``*_two_loads`` entries are reads of it. ``value`` is
the sum of the times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripmart.plans.queries import queries, two_load_warehouse  # noqa: E402
from tripmart.session import build_session  # noqa: E402
from tripmart.sources import tables  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="tripmart-bench", shuffle_partitions=cpus,
                          extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                 "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    tables.SPREAD = cpus  # the benchmark files are one row group each
    registry = queries()
    names = argv[1:] or list(registry)
    # Warm the JVM (class loading, codegen caches) outside the timings.
    registry["dim_location"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    if any(n.endswith("_two_loads") or n == "layer_views" for n in names):
        t0 = time.perf_counter()
        two_load_warehouse(spark, sf_dir)
        timings["two_load_build"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
