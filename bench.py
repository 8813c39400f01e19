"""Headline queries, one JSON line on stdout.

BENCH_SF_DIR picks the tables, BENCH_CPUS the number of local cores. Each query is
built and run once after a short warm-up; results go to the no-op sink, so reading,
shuffles and all columns are paid for but nothing is gathered on the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from triagelake.plans.queries import QUERIES  # noqa: E402
from triagelake.session import local_session  # noqa: E402

HEADLINES = [
    "claims_scan", "capacity_summary", "cumulative_gains", "lift_by_decile", "top_k_rows", "confusion",
    "metrics_at_threshold", "class_report", "roc_points", "pr_points", "threshold_sweep", "best_threshold",
    "frozen_threshold", "risk_decisions", "investigation_queue", "prediction_check", "class_balance",
    "fraud_rate_by_segment", "numeric_describe", "correlation_matrix", "histogram_by_class", "distinct_values",
    "stratified_split", "category_codes", "ordinal_codes", "scaled_features", "legacy_prepared", "smote_rows",
    "model_winner", "benchmark_logistic_regression", "benchmark_decision_tree", "batch_scoring",
]


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    try:
        for name in ("confusion", "capacity_summary", "stratified_split"):
            run(spark, name, folder)
        times = {name: run(spark, name, folder) for name in sys.argv[1:] or HEADLINES}
    finally:
        spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
