"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is timed once after a short warm-up of the session, with its result
fully produced by the noop sink.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import load  # noqa: E402

HEADLINE = [
    "flagship_report", "scan_csv", "drop_null_rows", "fill_median_own", "quantile_trim_sequential", "iqr_fence_upper",
    "describe_table", "histogram", "kde_curve", "correlation_matrix", "mutual_information", "label_encode", "standard_scale",
    "pca_fit", "pca_transform", "pca_wide", "fast_ica", "kfold_contiguous", "kfold_stratified", "knn_join", "knn_classify",
    "random_oversample", "smote", "smote_tomek", "smote_enn", "adjust_proportion", "linear_regression", "ridge", "theil_sen", "ransac",
    "gaussian_naive_bayes", "logistic_regression", "decision_tree_regress", "random_forest_regress", "extra_trees_regress",
    "gradient_boosting_regress", "boosted_trees", "boosted_trees_regress", "adaboost_regress", "svr", "kernel_ridge", "mlp_regress",
    "grid_search_cv", "grid_search_smoothing", "grid_search_ridge", "multi_metric_search", "trim_sweep", "cv_score_table", "roc_auc",
    "classification_report", "compare_prediction_tables", "property_price_linear", "credit_default_flow",
]


def session(cpus):
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowloom-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", os.environ.get("ROWLOOM_CHECKPOINTS", "/tmp/rowloom-checkpoints"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries, _ = load()
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
