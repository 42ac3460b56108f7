"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1) and ``BENCH_CPUS`` the threads.
Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HEADLINE = [
    "numeric_summary", "categorical_summary", "dq_report", "dq_missing", "dq_duplicates", "dq_outliers_iqr",
    "histogram", "kde", "corr_pearson", "corr_spearman", "kendall", "box_stats",
    "impute_median", "dedup", "clean_chain", "holdout_exact_n", "kfold_hash", "kfold_contiguous",
    "transform_chain", "onehot_apply", "scale_apply", "chi2", "anova", "ttest",
    "regression_metrics", "metrics_by_model", "ridge_single", "cross_validate",
    "permutation_importance", "noise_robustness", "batch_score",
    "baseline_table", "tuning_trials", "rfecv_ranking", "profile_plan",
    "boosting_best_first", "learning_curve_ridge", "dq_duplicates_wide",
]


def main() -> None:
    from plumbline.session import local_session, temporary_tables
    from plumbline.workload import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    for name in wanted:
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # The whole result is computed but not brought to the driver.
            with temporary_tables(spark):
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
