"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The value is the total of the best of two runs per query. ``messages_per_sec`` is the rate of the full
detection chain (raw JSON text to accepted readings and events).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorwarden.plans.queries import QUERIES  # noqa: E402
from sensorwarden.session import build_session  # noqa: E402

HEADLINES = (
    "parse_readings",
    "replay_events",
    "security_events",
    "offline_events",
    "liveness_sessions",
    "node_metrics",
    "latest_by_device_ts",
    "recent_events",
    "oid_export",
    "threshold_alerts",
    "threshold_requests",
    "pipeline_counters",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    messages = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times = {}
    for name in HEADLINES:
        best = None
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "messages": messages,
                "messages_per_sec": round(messages / times["pipeline_counters"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
