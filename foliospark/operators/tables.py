"""Report tables built from runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import scores
from foliospark.operators.runs import top_per_group

# The metric a comparison is sorted by, in order of preference.
SORT_METRICS = ["test_accuracy", "Test Metrics_accuracy"]


def accuracy_column(columns: Sequence[str]) -> str | None:
    """First name with accuracy in it that is neither a fold score nor a spread."""
    for c in columns:
        low = c.lower()
        if "accuracy" in low and "cv" not in low and "std" not in low:
            return c
    return None


def first_accuracy_metric(metrics: DataFrame) -> DataFrame:
    """The same rule over a long metric table: first key by name."""
    return metrics.where(scores.is_plain_accuracy("key")).agg(F.min("key").alias("key"))


def comparison_table(runs: DataFrame, metric_columns: Sequence[str]) -> DataFrame:
    """Labels, runtime and rounded metrics, best accuracy first."""
    table = runs.select(
        scores.short_label("run_name", 50).alias("experiment"),
        F.concat(F.substring(F.col("run_id").cast("string"), 1, 8), F.lit("...")).alias("task_id"),
        "status",
        scores.round_even(F.when(F.col("runtime_min") != 0, F.col("runtime_min")), 2).alias("runtime_min"),
        scores.minute_stamp("created").alias("created"),
        *[scores.round_even(c, 4).alias(c) for c in metric_columns],
        F.col("run_id").alias("_id"),
    )
    named = [c for c in SORT_METRICS if c in metric_columns]
    named += [c for c in metric_columns if "accuracy" in c.lower()]
    if named:
        table = table.orderBy(F.col(named[0]).desc_nulls_last(), "_id")
    return table.drop("_id")


def summary_table(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Label, status, runtime, creation minute, first accuracy and first F1 metric."""
    key = F.lower("key")

    def first_value(word: str):
        return F.min_by("value", F.when(key.contains(word), F.col("key")))

    firsts = metrics.groupBy("run_id").agg(
        first_value("accuracy").alias("_accuracy"), first_value("f1").alias("_f1")
    )
    return (
        runs.join(firsts, "run_id", "left")
        .select(
            "run_id",
            scores.short_label("run_name", 40).alias("experiment"),
            "status",
            scores.round_even(F.when(F.col("runtime_min") > 0, F.col("runtime_min")), 2).alias("runtime_min"),
            scores.minute_stamp("created").alias("created"),
            scores.round_even("_accuracy", 4).alias("accuracy"),
            scores.round_even("_f1", 4).alias("f1_score"),
        )
        .orderBy(F.col("accuracy").desc_nulls_last(), "run_id")
    )


def result_table(runs: DataFrame, accuracy: str, f1: str) -> DataFrame:
    """Name, family, accuracy and F1 with 0 for an absent one."""
    return runs.select(
        "run_name",
        scores.algorithm_family("run_name").alias("family"),
        F.coalesce(accuracy, F.lit(0.0)).alias("accuracy"),
        F.coalesce(f1, F.lit(0.0)).alias("f1_score"),
    )


def top_by_scores(results: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """Top n successful results by each score, stacked as `(ranking, place, ...)`.

    One pass: every row is offered to each ranking and `top_per_group` keeps n
    rows per ranking and task.
    """
    good = results.where(F.col("status") == "success")
    offers = F.array(
        *[F.struct(F.lit(c).alias("ranking"), F.col(c).alias("score")) for c in columns]
    )
    stacked = good.select("run_id", "run_name", "algorithm", F.inline(offers))
    top = top_per_group(stacked, "ranking", "score", "run_id", n)
    return top.withColumnRenamed("rank", "place")


def bar_top(metrics: DataFrame, n: int = 10) -> DataFrame:
    """Top n runs per metric."""
    return top_per_group(metrics, "key", "value", "run_id", n)
