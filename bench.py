"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_readings_range", "resample_15m_mean", "net_sum_of_means", "net_mean_of_sums", "counter_to_power", "align_full_outer",
    "primary_backup_coalesce", "grid_reindex", "interp_limit2", "interp_time_both", "lag_time_range", "lag_rows",
    "lag_onto_horizon", "dedup_last", "upsert_keep_last", "tail_n_rows", "fold_expanding", "campus_closed", "holiday_join",
    "feature_panel", "json_zone_price_extract", "price_design_matrix", "price_design_scaled", "build_electric_dataset",
    "build_thermal_dataset", "update_prices", "lear_forecast", "lear_backtest", "rf_fit", "rf_grid_contiguous",
    "rf_grid_expanding", "rf_retrain", "day_ahead_forecast", "train_load_models", "stream_resample",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("loadcast-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from loadcast.plans.queries import QUERIES, prepare

    only = sys.argv[1:] or HEADLINE
    prepare(spark, sf_dir)  # the history tables and saved models that queries start from; also warms the JVM
    times = {}
    for name in only:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": float(sf.group(1)) if sf else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
