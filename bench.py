"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores. Each query is run once to warm
up and then timed over ``BENCH_RUNS`` runs, of which the fastest counts; results go to
Spark's no-op sink, so every column of every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wickwork.catalog import QUERIES  # noqa: E402
from wickwork.session import build_session  # noqa: E402

HEADLINE = [
    "silver_dedupe",
    "ohlcv_daily",
    "ohlcv_hourly",
    "ohlcv_fine_hourly",
    "ohlcv_incremental",
    "reject_counts",
    "latest_closed",
    "fetch_start",
    "klines_parse",
    "tickers_parse",
    "series_align",
    "series_parse",
    "archive_select",
    "symbol_match",
    "tradeable_split",
    "top_coins",
    "listing_rank",
    "latest_listings",
    "work_grid",
    "upsert_plain",
    "upsert_guarded",
    "upsert_snapshots",
    "upsert_markets",
    "upsert_market_cap",
    "prune_months",
    "serving_hourly",
    "today_merge",
    "range_scan",
    "metric_query_base",
    "metric_query_average",
    "rollup_build",
    "pk_dupes",
    "fk_orphans",
    "lag_alert",
]
# Timed too, but few times: they write tables or run streams.
WRITING = [
    "ndjson_load",
    "gold_incremental",
    "upsert_guarded_table",
    "prune_table",
    "metric_query_rollup",
    "stream_bronze",
    "stream_ohlcv",
]


def timed(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE + WRITING
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(max(int(cpus) if cpus.isdigit() else 8, 1)),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        timed(spark, name, folder)
        repeat = 1 if name in WRITING else runs
        times[name] = round(min(timed(spark, name, folder) for _ in range(repeat)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
