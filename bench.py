"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3); the median counts. Queries longer
than LONG_SECONDS are timed once. Results are computed in full and dropped (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wakeline_checks.compare import local_session

LONG_SECONDS = 8.0

HEADLINE = (
    "p1_parse_json",
    "a10_row_accounting",
    "p11_rejects_as_text",
    "x10_batch_clean",
    "e5_clean_history",
    "j1_ports_in_range",
    "w2_previous_ping",
    "w3_gap_sessions",
    "a4_port_dwell_times",
    "a4_port_visits_whole_range",
    "a5_fleet_daily_kpis",
    "a6_route_density_grid",
    "p18_speed_alerts",
    "w1_latest_per_vessel",
    "m4_assign_clusters",
    "a7_cluster_percentile",
    "p28_cluster_rows",
    "m6_behaviour_job",
    "a24_cluster_matrix",
    "a26_distance_histogram",
    "l1_top_outliers",
    "s9_overwrite_by_date",
    "s14_upsert_stored",
    "x2_stream_dedup_archive",
    "t3_word_count",
    "t7_months_side_by_side",
)


def main(keys: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    from wakeline_checks import QUERIES

    timings = {}
    for key in keys or HEADLINE:
        taken = []
        for attempt in range(runs + 1):
            started = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - started
            if attempt > 0:
                taken.append(seconds)
                if seconds > LONG_SECONDS:
                    break
        timings[key] = round(statistics.median(taken), 3)
        print(f"{key:36s} {timings[key]:8.3f}s", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main(sys.argv[1:])
