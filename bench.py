"""Benchmark: every registered query on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver).  One untimed warm-up pass
(JVM start, JIT, file listing caches), then ``BENCH_RUNS`` (default 2) timed
passes; the per-query figure is the best timed pass (the figure includes
building the plan in Python).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(app_name="tessera-bench")
    queries = {n: q for n, q in load_all().items() if not only or n in only}

    errors: dict[str, str] = {}
    for name, q in queries.items():  # warm-up
        try:
            run_once(spark, q.fn, sf_dir)
        except Exception as e:  # keep benchmarking the others, report it
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    timings: dict[str, float] = {}
    for name, q in queries.items():
        if name in errors:
            continue
        timings[name] = round(min(run_once(spark, q.fn, sf_dir) for _ in range(runs)), 3)

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "runs": runs,
        "stat": "min",
        "cpus": spark.sparkContext.defaultParallelism,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
