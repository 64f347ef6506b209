"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from quayside.plans import QUERIES  # noqa: E402

HEADLINES = [
    "typed_order_load",
    "a1_fixed_width_scan",
    "a13_ready_marker_gate",
    "b2_typed_projection",
    "b17_float_widening",
    "c15_decimal_cleanup",
    "c34_jtrim",
    "c38_strip_non_ascii",
    "d1_subset_filter_mixed",
    "e1_choose_strategy",
    "f3_merge_scd1",
    "f4_merge_scd2",
    "f5_dedup_latest",
    "g8_partition_upsert",
    "g12_doc_merge_updates",
    "g15_stream_body_sink",
    "h2_stream_upsert",
    "i1_job_metrics_fact",
    "i9_usage_rollup",
    "i16_lineage_closure",
    "i17_lineage_tree",
    "j4_dependency_edges",
    "j7_consecutive_groups",
    "k3_join_full_outer",
    "k4_cube",
    "k5_window_running_total",
    "k6_qualify",
    "k10_lateral_view",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("quayside-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["typed_order_load"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    only = sys.argv[1:]
    times = {}
    for name in HEADLINES:
        if only and name not in only:
            continue
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
