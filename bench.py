"""Benchmark: run every registered analysis on one data directory.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (default 3; the median of the warm runs is
reported).  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Each query is fully executed with a no-op sink (``write.format("noop")``),
so the whole plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storelens.plans.registry import QUERIES  # noqa: E402
from storelens.session import get_session  # noqa: E402


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    spark = get_session(f"local[{cpus}]", app_name="storelens-bench",
                        shuffle_partitions=parts,
                        extra_conf={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for key, fn in QUERIES.items():
        samples = []
        try:
            for i in range(runs + 1):           # first run warms the JVM and file cache
                t0 = time.perf_counter()
                fn(spark, root).write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
        except Exception as exc:  # noqa: BLE001 - report and go on with the other keys
            errors[key] = f"{type(exc).__name__}: {str(exc)[:300]}"
            continue
        times[key] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", root)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else root,
                      "config": {"master": f"local[{cpus}]", "shuffle_partitions": parts,
                                 "runs": runs, "spark": spark.version},
                      **({"errors": errors} if errors else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
