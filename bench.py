"""Time the headline queries and print one JSON line.

The tables come as one file with one row group each, which one task has to scan. They
are first written, untimed, in as many files as cores, as tables of a cluster are. The
two runs with `_100` in their name are training runs on 100 documents.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from foliospark.operators import model
from foliospark.queries import load
from foliospark.queries.models import INPUTS, corpus
from foliospark.session import local_session

HEADLINE = [
    "clean_text", "clean_text_markup", "publications_processed", "length_by_bin",
    "category_top10", "frame_profile", "completeness_ratio",
    "run_assembly", "compare_runs", "leaderboard", "runs_by_thresholds", "summary_table",
    "final_metric_value", "minmax_matrix", "metric_summary", "algo_stats", "runtime_stats",
    "runtime_histogram", "running_best", "top_n_per_algorithm", "stage_transition",
    "status_windows", "weighted_scores", "roc_auc_ovr",
    "tokenize", "vocab_prune", "tfidf", "stratified_folds", "train_rf", "train_lr",
]
SMALL = {
    "train_rf_100": (model.RANDOM_FOREST, {}),
    "train_lr_100": (model.LOGISTIC, {"solver": "lbfgs"}),
}
_SMALL_FILE = 1 << 20


def spread(spark, folder: str, files: int) -> str:
    """The tables in `files` files each, small ones in one."""
    target = tempfile.mkdtemp(prefix="foliospark-bench-")
    for name in sorted(os.listdir(folder)):
        path = os.path.join(folder, name)
        if not name.endswith(".parquet"):
            continue
        large = os.path.isdir(path) or os.path.getsize(path) > _SMALL_FILE
        spark.read.parquet(path).repartition(files if large else 1).write.parquet(os.path.join(target, name))
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    registered = load()
    inputs = spread(spark, folder, int(cores))

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    def query(name: str) -> None:
        registered[name].run(spark, inputs).write.format("noop").mode("overwrite").save()

    def train(algorithm: str, params: dict) -> None:
        prepared = model.prepare(corpus(spark, inputs).limit(100), INPUTS)
        fitted = model.fit(prepared, model.TrainConfig(algorithm, algorithm, params))
        model.test_scores(model.predict(fitted, prepared.test), len(prepared.classes))
        prepared.release()

    query("length_by_bin")  # warm the JVM
    times = {name: timed(lambda name=name: query(name)) for name in HEADLINE}
    times |= {name: timed(lambda job=job: train(*job)) for name, job in SMALL.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
