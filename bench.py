"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    timed runs per query after one warm-up; the best counts (default 1)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from billshift.registry.queries import QUERIES  # noqa: E402
from billshift.session import tuned  # noqa: E402
from billshift.sources.writers import clear_scratch  # noqa: E402

HEADLINE = [
    "increment",
    "all_flags",
    "new_model_reports",
    "n_report_alerts",
    "welch_test",
    "before_after",
    "residuals",
    "skipped_audit",
    "skipped_audit_profile",
    "education_status",
    "regression_metrics",
    "metrics_merge",
    "hash_split",
    "blank_token",
    "scoring_frame_a",
    "training_frame_dme",
    "code_levels",
    "feature_activity",
    "params_map",
    "missing_models",
    "ml_evaluation",
]
SLOW = {"ml_evaluation"}  # one timed run, no warm-up


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        tuned(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        clear_scratch(spark)
        return seconds

    seconds = {}
    for name in names:
        if name not in SLOW:
            once(name)
        seconds[name] = round(min(once(name) for _ in range(1 if name in SLOW else runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
