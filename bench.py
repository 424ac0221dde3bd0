"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected), timed wall-clock, and reported as one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from modelyard.registry import QUERIES, load_all  # noqa: E402
from modelyard.session import local_session, ship_package  # noqa: E402

HEADLINE = [
    "lineitem_leaderboard",     # score + measure all closed-form models on lineitem
    "lineitem_cv_metrics",      # k-fold metrics on lineitem
    "auc",                      # ROC / AUC on labels joined to documents
    "epoch_batches",            # batching embeddings
    "regression_leaderboard",
    "hash_split_rows",
    "session_sql",
    "roc_points",
    "nearest_class_mean",
    "registry_versions",
    "shuffle_order",
    "domain_values",
    "class_score_grid",
    "grouped_least_squares",
    "gang_shard_sums",
    "dense_network",
    "automl_leaderboard",
    "automl_cv_leaderboard",
    "classifier_comparison",
    "stratified_holdout",
    "binned_auc",
    "cv_regressor_metrics",
    "sync_network_shards",
    "endless_feed",
]


def run(name, spark, sf_dir):
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    ship_package(spark)
    load_all()
    run("regression_leaderboard", spark, sf_dir)  # warm-up: JVM, codegen caches
    times = {}
    for n in names:
        times[n] = round(run(n, spark, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
