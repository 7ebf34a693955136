"""Benchmark: every catalogue query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is planned and executed to completion with the ``noop`` sink
(the whole plan runs, nothing is collected to the driver). Prints one JSON
line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.catalog import queries  # noqa: E402
from strata.session import get_spark, release_scratch  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = get_spark("strata-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "4g"))
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, parquet footers, codegen caches
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, q in queries().items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_scratch()  # this query's staged tables are no longer read
        print(f"# {name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
