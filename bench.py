"""Times the headline queries: one warm-up and the best of a few runs each; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.catalog import QUERIES  # noqa: E402
from workload.check import session  # noqa: E402

HEADLINE = (
    "station_metrics",
    "monthly_category_sums",
    "category_share",
    "dense_station_panel",
    "district_rollup",
    "city_rollup",
    "month_completeness",
    "complete_month_rows",
    "station_baseline",
    "district_baseline",
    "city_baseline",
    "station_comparison",
    "station_published",
    "district_published",
    "city_published",
    "category_pivot",
    "local_station_panel",
    "district_exact_rollup",
    "clean_counter_deltas",
    "outlier_devices_removed",
    "daily_complex_sums",
    "counter_daily_table",
    "counter_baseline_station",
    "duplicate_row_summary",
    "duplicate_text_summary",
    "point_in_polygon",
    "hourly_csv_scan",
    "weekly_counter_files",
    "month_landing",
    "incremental_update",
    "targeted_refresh",
    "monthly_update_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus, int(cpus) if cpus.isdigit() else 8)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(1 if name == "monthly_update_run" else runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        timings[name] = round(best, 3)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "lineitem_rows_per_sec": round(lines / timings["station_metrics"]),
            }
        )
    )


if __name__ == "__main__":
    main()
