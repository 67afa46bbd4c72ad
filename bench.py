"""Bench: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (whole plan
executed, nothing shipped to the driver).  One warm-up query first.  Prints
one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obslake.session import local_session  # noqa: E402
from obslake.plans import catalog  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    catalog.fact_current_a(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    # Landing the derived feed is a stage of its own: most queries read it.
    t0 = time.perf_counter()
    catalog.landed_root(spark, sf_dir)
    timings: dict[str, float | None] = {"landing": round(time.perf_counter() - t0, 3)}
    errors: dict[str, str] = {}
    for name, fn in catalog.QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep timing the others; report the failure
            timings[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(t for t in timings.values() if t is not None), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
