"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cohortloom.plans import QUERIES  # noqa: E402

HEADLINE = [
    "metrics_table",
    "event_count_metrics",
    "record_length_metrics",
    "common_codes",
    "index_date",
    "observation_window",
    "aggregate_events",
    "samples",
    "feat_construct",
    "phenotype_label",
    "icu_stay_features",
    "roc_points",
    "roc_auc",
    "graph_build",
    "jaccard_one_vs_all",
    "jaccard_all_pairs",
    "random_walk",
    "nmf_update_h",
    "nmf",
    "kmeans",
    "stream_kmeans",
    "sgd_logistic",
    "sgd_train_ensemble",
    "clf_logistic",
    "pic",
    "phenotype_clustering",
    "grid_search_cv",
    "stack_models",
    "gmm",
    "pca_project",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["cohort_split"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
