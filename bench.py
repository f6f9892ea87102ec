"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR   folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
    BENCH_RUNS     timed runs per batch query after one warm-up, median is reported (default 3);
                   a streaming job runs once
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillwatch.plans.catalog import QUERIES  # noqa: E402
from tillwatch.session import build_session  # noqa: E402

HEADLINE = [
    "fraud_score", "sink_transactions", "flagged_only", "expand_txn", "validate_dlq_reason",
    "enrich_customers", "enrich_risk", "velocity_snapshot", "velocity_trailing",
    "velocity_trailing_24h", "emit_scored", "parse_scored", "lake_merge_insert", "latest_by_key",
    "latest_per_user", "risk_profile_features", "dashboard_stats", "top_risky_users",
    "recent_fraud_scores", "running_totals", "quality_gate",
]
STREAMS = ["velocity_5min", "hot_fanout", "lake_stream"]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(runs))
    for name in STREAMS:
        seconds[name] = timed(QUERIES[name], spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "transactions": rows,
        "scored_per_second": round(rows / seconds["fraud_score"]),
    }))


if __name__ == "__main__":
    main()
