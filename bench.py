"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores. A query's
time runs from building its DataFrame to having produced every row and column (the ``noop``
sink); it is the median of three runs after one that is not counted, so that the first
compilation does not count. Queries that write files or train models run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from windrow.plans.queries import all_queries
from windrow.session import local_session
from windrow.sources import fixture

REPEATED = [
    "silver_flights", "clean_steps", "clean_report", "delay_category_counts",
    "airport_kpis", "airline_kpis", "temporal_kpis", "route_kpis",
    "airport_kpis_simple", "airline_kpis_simple", "temporal_kpis_simple",
    "features_full", "features_simple", "carrier_month_topk", "carrier_month_rank",
    "hourly_profile", "season_profile", "target_describe", "worst_best", "worst_hours",
    "sample_n", "ml_split_stratified", "metric_regression", "metric_auc",
]
ONCE = [
    "csv_scan", "bronze_rows", "silver_roundtrip", "silver_upsert", "compact_rows",
    "ml_regression", "ml_classification",
]


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    queries = all_queries()
    start = time.perf_counter()
    fixture.bronze(spark, sf_dir)
    seconds = {"bronze_build": round(time.perf_counter() - start, 3)}
    for name in REPEATED + ONCE:
        if name in REPEATED:
            run(spark, queries[name], sf_dir)
            times = [run(spark, queries[name], sf_dir) for _ in range(3)]
        else:
            times = [run(spark, queries[name], sf_dir)]
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
