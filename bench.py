"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is planned, run and drained once, without collecting. The JVM is
warmed beforehand with ``session_sequence``, which is not among them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "level_spans", "engagement_stats", "level_comparison", "play_level_share", "daily_trend", "hourly_plays",
    "plays_by_region", "top_users", "percent_rank", "label_matrix", "count_between", "most_played",
    "songplay", "songplay_dense", "lookup_one", "users_latest", "songs", "artists_latest", "time_dimension",
    "insert_ignore", "upsert_users", "overwrite_by_key", "lake_build", "users_by_song", "partition_lookup",
    "hull_corners", "episode_centre", "key_report", "truncation_report", "key_histogram", "orphans",
    "json_lines", "json_records", "staging_accepted", "error_report", "csv_columns", "incremental_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["session_sequence"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.monotonic()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - began, 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
