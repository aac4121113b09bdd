"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4). Each query runs
once to warm up and then ``RUNS`` times; the best time counts. Serving tables are written before the
clock starts, as they exist before a dashboard asks; ``write_replay_table`` and ``write_live_table``
measure making them from raw rows.
"""

from __future__ import annotations

import json
import os
import time

import querybook
from querybook import views
from roadpulse.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = 2
HEADLINE = [
    "build_features", "hotspots", "gold_clean", "live_features", "top_hotspots_full", "map_points",
    "latest_predictions", "nearby", "nearby_join", "timeseries_day", "severity_distribution", "risk_by_hour",
    "risk_by_weather", "weather_histogram", "overview_exact", "throughput", "latency",
    "upsert_latest", "update_from", "weather_asof", "change_status", "class_report", "proba_metrics",
    "numeric_summary", "corr_matrix", "flag_stats", "stratified_cap", "scenario_compare",
]


def drain(df) -> None:
    """Computes every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)), "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    raw_rows = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    queries = querybook.all_queries()
    seconds: dict[str, float] = {}

    drain(views.replay_of(views.raw_replay(spark, SF_DIR)))
    start = time.monotonic()
    views.replay(spark, SF_DIR)
    seconds["write_replay_table"] = round(time.monotonic() - start, 3)
    drain(views.live_of(views.live_base(spark, SF_DIR), views.hourly_weather(spark, SF_DIR)))
    start = time.monotonic()
    views.live(spark, SF_DIR)
    seconds["write_live_table"] = round(time.monotonic() - start, 3)

    for name in HEADLINE:
        best = None
        for i in range(RUNS + 1):
            start = time.monotonic()
            drain(queries[name](spark, SF_DIR))
            took = time.monotonic() - start
            if i:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)

    queries["stream_replay"](spark, SF_DIR)
    start = time.monotonic()
    queries["stream_replay"](spark, SF_DIR)
    seconds["stream_replay_drain"] = round(time.monotonic() - start, 3)

    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries, best run each", "value": round(sum(seconds.values()), 3),
                "unit": "sec", "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(CPUS),
                "raw_rows": raw_rows,
                "feature_rows_per_sec": round(raw_rows / seconds["build_features"], 1),
                "replay_stream_rows_per_sec": round(raw_rows / seconds["stream_replay_drain"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
