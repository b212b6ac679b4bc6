"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (every row computed, nothing
collected). One warm-up pass, then ``BENCH_REPEAT`` timed passes; the per-query figure is
the median, ``value`` their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheaf.plans.registry import BENCH, queries  # noqa: E402
from sheaf.session import get_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = get_session(
        f"local[{cpus}]",
        app_name="sheaf-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")},
    )
    qs = queries()
    for name in BENCH:
        run(qs[name](spark, sf_dir))
    times: dict[str, list[float]] = {name: [] for name in BENCH}
    for _ in range(repeat):
        for name in BENCH:
            t0 = time.perf_counter()
            run(qs[name](spark, sf_dir))
            times[name].append(time.perf_counter() - t0)
    per_query = {name: round(statistics.median(ts), 4) for name, ts in times.items()}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 4),
        "unit": "sec",
        "queries": per_query,
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
