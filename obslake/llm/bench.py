"""Seconds of the training-data queries: ``python -m obslake.llm.bench``.

The same settings as the feed's bench ($BENCH_SF_DIR, $BENCH_CPUS,
$BENCH_QUERIES), one JSON line, and with ``--plans`` each query's physical plan
before it."""

from __future__ import annotations

import json
import os
import sys
import time

from obslake.llm.queries import QUERIES
from obslake.session import local_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    timings = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        df = query(spark, sf_dir)
        if "--plans" in sys.argv:
            print(f"## {name}")
            df.explain("formatted")
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
