"""Time the headline queries on the tables at ``$BENCH_SF_DIR`` and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from riskloom.plans.catalog import QUERIES
from riskloom.runtime import build_session

HEADLINE = (
    "clean_applications",
    "clean_class_balance",
    "clean_notebook_variant",
    "rare_to_null",
    "describe_numeric",
    "describe_categorical",
    "value_counts",
    "n_unique",
    "correlation_matrix",
    "box_summary",
    "histogram",
    "density_curve",
    "stratified_split",
    "repeated_folds",
    "classification_metrics",
    "metrics_by_phase",
    "roc_curve",
    "inject_numeric_drift",
    "inject_category_drift",
    "drift_report",
    "impute_median",
    "binary_encode",
    "preprocess_live",
    "nearest_neighbors",
    "smote",
    "near_miss_1",
    "group_winners",
    "fit_logistic_l2",
    "fit_random_forest",
    "score_requests",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    QUERIES["clean_class_balance"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
