"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Set BENCH_WARM to run every query once before it is timed, and BENCH_QUERIES to time only some.
Results go to Spark's no-op sink, so that whole results are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weirflow.plans.registry import all_queries  # noqa: E402
from weirflow.session import local_session  # noqa: E402


def run(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or list(all_queries())
    spark = local_session("bench", cores, int(cores), **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    run(queries["num_events"], spark, folder)
    seconds = {}
    for name in names:
        try:
            if "BENCH_WARM" in os.environ:
                run(queries[name], spark, folder)
            seconds[name] = round(run(queries[name], spark, folder), 3)
        except Exception as error:  # noqa: BLE001 - one failing query must not hide the others
            print(f"{name}: {str(error)[:300]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "failed": sorted(set(names) - set(seconds)),
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
