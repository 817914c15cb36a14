"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query is run once to warm up and
then timed as the median of BENCH_RUNS runs (2); each run computes the whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from isohour.plans.catalogue import QUERIES  # noqa: E402
from isohour.session import local_session  # noqa: E402

HEADLINE = (
    "scan_project",
    "dedup_latest",
    "dedup_latest_aggregate",
    "hourly_mart",
    "daily_mart",
    "full_profile",
    "duplicate_keys",
    "unique_check",
    "relationships_check",
    "month_partition_profile",
    "payload_explode",
    "upsert_delete_insert",
    "upsert_stored_table",
    "audit_carry_forward",
    "lag_features",
    "rolling_features",
    "feature_table",
    "clock_lags",
    "time_series_folds",
    "regression_metrics",
    "classification_metrics",
    "cross_validated_linear",
    "forecast_seed_features",
    "linear_recursive_forecast",
    "forecast_publish",
    "warehouse_refresh",
    "stream_daily_totals",
    "stream_latest_per_hour",
    "fitted_linear_forecast",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    took: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
