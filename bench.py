"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from tabloom.plans.catalogue import QUERIES

HEADLINE = (
    "modeling_table", "dq_checks", "missingness", "duplicate_rows", "stratified_split", "stratified_folds",
    "one_hot", "feature_matrix", "global_rank", "priority_rank", "average_precision", "roc_auc",
    "line_rank", "value_ranking", "capacity_metrics", "fairness_by_group", "holdout_report", "dummy_baseline", "request_contract",
    "score_batch", "cv_report",
)
# One warm-up and the best of this many runs; model fits run once.
REPEATS = 2
ONCE = {"cv_report"}


def run(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="tabloom-bench-")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", scratch)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(1 if name in ONCE else REPEATS + 1):
            start = time.perf_counter()
            run(QUERIES[name](spark, folder))
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
