"""Time the four reports and print one JSON line.

Each report runs once cold and five times warm; ``queries`` holds the warm medians and ``value`` their sum.
The result is written to a ``noop`` sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from bizmetrics.queries import QUERIES
from bizmetrics.session import local_session

REPORTS = ["r1_business_metrics", "r2_partner_usage", "r3_product_adoption", "r4_sales_performance"]
WARM_RUNS = 5


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = local_session(cores, app="bench")
    cold, warm = {}, {}
    for name in REPORTS:
        cold[name] = seconds(lambda: QUERIES[name](spark, sf_dir))
    for name in REPORTS:
        warm[name] = statistics.median(seconds(lambda: QUERIES[name](spark, sf_dir)) for _ in range(WARM_RUNS))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "four reports, sum of warm medians",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in warm.items()},
                "cold": {name: round(s, 3) for name, s in cold.items()},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cores),
            }
        )
    )


if __name__ == "__main__":
    main()
