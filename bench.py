"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (runs per query,
the fastest counts).
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.plans.catalog import REGISTRY  # noqa: E402

HEADLINE = [
    "p1_clean",
    "f3_validate",
    "f4_rejected_rows",
    "f5_enrich",
    "a1_hourly_borough_stats",
    "a4_hourly_table",
    "a5_network_summary",
    "a7_stream_quality",
    "a10_congestion_snapshot",
    "a12_executive_summary",
    "a19_congestion_heatmap",
    "a20_borough_performance",
    "a24_anomaly_summary",
    "a31_overview_kpis",
    "j1_stats_with_levels",
    "l5_replay",
    "m1_imputer_medians",
    "m8_classification_report",
    "m10_regression_report",
    "m17_calibration_bins",
    "s11_upsert_merge",
    "t1_traffic_live",
    "w1_latest_per_link",
    "w3_dominant_level",
    "w4_temporal_split",
    "x1_stream_processing",
    "x4_stream_routing",
    "x7_stream_hourly_windows",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        spent = []
        for _ in range(runs):
            started = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - started)
        seconds[name] = round(min(spent), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
