"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfmark.checks.queries import QUERIES  # noqa: E402
from shelfmark.session import build_session  # noqa: E402

HEADLINE = (
    "snapshot_diff",
    "snapshot_diff_days",
    "latest_by_id",
    "stage",
    "project_star_plus",
    "extract_attributes",
    "sold_products_mart",
    "read_raw_json",
    "write_base_parquet",
    "append_day",
    "check_staging",
    "dq_unique",
    "dq_valid_vendors",
    "missing_drops",
    "filter_sold",
    "sales_by_weekday",
    "sales_per_day",
    "sales_per_day_vendor",
    "vendor_totals",
    "revenue_per_day",
    "products_by_vendor",
    "sales_by_color_day",
    "box_stats_price",
    "box_stats_days",
    "box_outliers",
    "bounds",
    "price_vs_type_points",
    "price_vs_condition_points",
    "rebuild_sold",
    "dashboard",
)


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "shelfmark-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = QUERIES[name]
        timed(lambda: query(spark, sf_dir))
        seconds[name] = round(statistics.median(timed(lambda: query(spark, sf_dir)) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
