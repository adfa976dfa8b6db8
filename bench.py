"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and, for a
subset, BENCH_QUERIES (comma-separated names). The same queries, and the ensemble with its
default settings, are timed on a second scale too: BENCH_SECOND_DIR (default
/root/testdata/sf0.01, empty for none). ``value`` is the sum on the first scale.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

import workload

HEADLINE = [
    "yearly_repeat_summary", "thin_recent", "next_purchase", "purchase_ordinal", "self_join_views",
    "period_split", "holdout_next_type", "quantile_edges_linear", "quantile_edges_many",
    "quantile_bin_numbered", "map_values", "range_validate", "area_cascade", "group_min_maturity",
    "gender_rule", "ratio_band", "downsample_exact", "split_exact", "class_report", "knn_classify",
    "train_ensemble_score",
]
SECOND = ["knn_blocks", "whole_preparation", "default_ensemble_score"]


def scale(folder: str) -> str:
    return os.path.basename(folder.rstrip("/")).removeprefix("sf")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlens-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = workload.queries()
    # start the executors and the parquet reader before the clock
    spark.read.parquet(f"{folder}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    def timed(folder, names):
        seconds = {}
        for name in names:
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        return seconds

    seconds = timed(folder, names)
    total = round(sum(seconds.values()), 3)
    second = os.environ.get("BENCH_SECOND_DIR", "/root/testdata/sf0.01")
    other = {"sf": scale(second), "queries": timed(second, [*names, *SECOND])} if second else None
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": scale(folder),
                "second_scale": other,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
