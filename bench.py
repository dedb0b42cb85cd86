"""Benchmark: run the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (every row computed, nothing
collected to the driver). Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset; default all registered queries).
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
    from sparkloom.plans.registry import all_queries
    from sparkloom.session import drop_scratch_tables, get_spark

    spark = get_spark(
        "sparkloom-bench", master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024)},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = os.environ.get("BENCH_QUERIES")
    names = [n.strip() for n in wanted.split(",")] if wanted else sorted(queries)

    # warm the JVM and the Python workers once, outside the timings
    spark.range(1000).selectExpr("sum(id)").collect()

    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        drop_scratch_tables(spark)  # the query's written intermediates are consumed
        print(f"# {name}: {timings[name]:.2f}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
