"""Bench: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {name: sec}, "sf", ...}.
Each query is executed in full through the no-op sink (nothing is collected).

    BENCH_SF_DIR=/root/testdata/sf0.01 python bench.py [name ...]
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from triad.plans import registry
    from triad.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = registry.queries()
    names = sys.argv[1:] or list(qs)

    # JVM and Python worker warm-up on the smallest table (not timed).
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for n in names:
        t0 = time.perf_counter()
        try:
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as ex:  # noqa: BLE001
            failed[n] = str(ex)[:200]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "driver_memory": spark.conf.get("spark.driver.memory", "default"),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
