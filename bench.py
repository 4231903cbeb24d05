"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best-of).  Each query is forced end to end with the
``noop`` sink (full computation, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from coursewise.session import get_session  # noqa: E402
from coursewise.plans import registry  # noqa: E402

HEADLINE = ["d13_stg_courses", "f12_course_snapshot", "f15_price_history", "g27_current_previous",
            "g12_overview_kpis", "e1_extract_links", "g2_price_history_enriched"]


def run(spark, name, sf_dir):
    """Seconds from building the query (which may run small sizing jobs) to its full result."""
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", cpus * 2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024 * 1024))
    # warm-up: every headline query once on the smallest tables, so JIT and the
    # codegen cache (keyed on generated code, the same at every scale) are hot
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in only:
            run(spark, name, warm)
    times = {}
    for name in only:
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(repeat)), 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "stg_courses_rows_per_sec": round(rows / times["d13_stg_courses"]) if "d13_stg_courses" in times else None,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
