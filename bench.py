"""Times the registered queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_QUERIES (comma-separated names).
Every query is planned and run to the end through Spark's no-op sink, BENCH_RUNS times (default 2); the
shorter time counts, so that code generation and class loading of the first run do not.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemart.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(QUERIES)
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
