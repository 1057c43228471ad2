"""Time the headline queries, each three times, and print one JSON line with the medians."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from footfall.session import build_session  # noqa: E402

HEADLINE = [
    "device_account_roll", "guid_resolution", "dense_ids", "place_fallback", "session_split", "sessions_from_events",
    "user_traffic", "traffic_cube", "share_cube", "region_rollup", "bitmap_merge", "active_range_roll", "active_bits_roll",
    "retention_history", "funnel_by_day", "attribution_models", "version_roll", "orders_at_level", "trait_classifier",
    "nearest_neighbours", "tfidf_weights",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    import catalog

    known = catalog.load()
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timings = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            known[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "runs": RUNS, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
