"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayfuse.plans.catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "vehicle_comm_stats", "fuse_topic", "fuse_record_metrics", "asof_nearest", "spatiotemporal_match", "bbox_intersect", "bbox_contain", "polygon_first",
    "gap_segments", "smooth_savgol", "resample_grid", "trajectory_samples", "enu_project", "utm_project", "grid_density_topk", "latency_heatmap",
    "hourly_pattern", "message_type_stats", "link_stats", "messages_per_vehicle_describe", "parse_v2x", "discovery_summary", "topic_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("vehicle_comm_stats")  # starts the JVM's compilers and reads the files once
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
