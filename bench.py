"""Time the registered queries: BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES (comma-separated; all by default).

A query of under REPEAT_BELOW seconds runs twice more, and the median counts, so that
compilation in its first run does not.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from demesne.queries import QUERIES  # noqa: E402
from demesne.session import local_session  # noqa: E402

REPEAT_BELOW = 2.0


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(spark, name: str, folder: str) -> float:
    first = run(spark, name, folder)
    return first if first >= REPEAT_BELOW else statistics.median([first, run(spark, name, folder), run(spark, name, folder)])


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = [n for n in chosen.split(",") if n and n != "all"] or list(QUERIES)
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    run(spark, "wl_trim", folder)  # start-up of the session is not a query
    times = {n: round(timed(spark, n, folder), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "total wall time of the queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
