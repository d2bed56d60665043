"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Every query runs once to warm up and then once
for the clock, with its whole result computed. The tree ensembles are fitted with the stated parameters but for the
number of trees, which the names tell; the network runs all its passes. ``stream_score`` scores with a small model.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import furrow.plans.queries as plans  # noqa: E402
from furrow.operators import training as ml  # noqa: E402
from furrow.plans.queries import QUERIES  # noqa: E402
from furrow.session import build_session  # noqa: E402

HEADLINE = [
    "clean_readings",
    "score_batch",
    "sink_sensors",
    "sink_predictions",
    "foreach_batch_fanout",
    "stream_clean",
    "log_extract",
    "csv_scan",
    "null_profile",
    "dedupe_rows",
    "duplicate_count",
    "category_cardinality",
    "top_categories",
    "crosstab_crop",
    "iqr_bounds",
    "boxplot_stats",
    "outlier_union",
    "category_dictionary",
    "label_encode",
    "rare_category_bucket",
    "stratified_split",
    "stratified_folds",
    "standardize",
    "classification_report",
    "roc_auc",
    "one_hot",
    "stream_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, run, runs=2):
        for _ in range(runs):
            start = time.perf_counter()
            run()
            times[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    train, _ = plans._parts(spark, sf_dir)
    prepared = ml.prepare(train)
    for name, learner in ml.candidates("reference").items():  # at their stated sizes
        timed(f"train_{name}", lambda: learner.fit(prepared.rows), runs=1)
    timed("train_mlp", lambda: ml.train_network(train, "reference"), runs=1)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
