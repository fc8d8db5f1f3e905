"""Statistics over runs and their metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import scores
from foliospark.plans.ordering import exact_median, running_totals
from foliospark.plans.scratch import written


def algorithm_stats(results: DataFrame) -> DataFrame:
    """Successful results per algorithm: count, mean and best accuracy and F1."""
    good = results.where(F.col("status") == "success")
    return good.groupBy("algorithm").agg(
        F.count("*").alias("n"),
        F.avg("test_accuracy").alias("mean_accuracy"),
        F.max("test_accuracy").alias("best_accuracy"),
        F.avg("test_f1_score").alias("mean_f1_score"),
        F.max("test_f1_score").alias("best_f1_score"),
    )


def algorithm_spread(runs: DataFrame, value: str, group: Column) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per algorithm family."""
    return runs.groupBy(group.alias("family")).agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def metric_summary(metrics: DataFrame) -> DataFrame:
    """Per metric key: mean, population deviation, minimum, maximum, count."""
    return metrics.groupBy("key").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("n"),
    )


def sweep_counts(results: DataFrame, good: str = "success") -> DataFrame:
    ok = F.col("status") == good
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
    )


def average_runtime(runs: DataFrame) -> DataFrame:
    """Mean runtime over runs that have a non-zero one."""
    return runs.agg(
        F.avg(F.when(F.col("runtime_min") != 0, F.col("runtime_min"))).alias("average_runtime_min")
    )


def runtime_stats(runs: DataFrame, value: str = "runtime_min") -> DataFrame:
    """Mean and exact median runtime."""
    mean = runs.agg(F.avg(value)).scalar()
    return exact_median(runs, value).select(
        mean.alias("mean_runtime"), F.col("median").alias("median_runtime")
    )


def histogram(df: DataFrame, value: str, max_bins: int = 10) -> DataFrame:
    """Equal-width histogram with `min(max_bins, n)` bins, empty ones included.

    The last bin is closed. Equal values get a range of one around them. Two
    passes: one for the range, one that counts per bin on the map side.
    """
    present = df.where(F.col(value).isNotNull())
    span = present.agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("n")
    ).where(F.col("n") > 0)
    flat = F.col("lo") == F.col("hi")
    span = span.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        F.least(F.col("n"), F.lit(max_bins)).cast("int").alias("bins"),
    )
    shape = span.select(F.struct("lo", "hi", "bins")).scalar()
    step = (F.col(value) - shape["lo"]) / (shape["hi"] - shape["lo"]) * shape["bins"]
    counts = present.groupBy(
        F.least(F.floor(step), shape["bins"] - 1).cast("int").alias("bin")
    ).agg(F.count("*").alias("n"))
    frame = span.select(
        F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"),
        "lo",
        ((F.col("hi") - F.col("lo")) / F.col("bins")).alias("width"),
    )
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("width") * F.col("bin")).alias("low_edge"),
        (F.col("lo") + F.col("width") * (F.col("bin") + 1)).alias("high_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def minmax_long(metrics: DataFrame) -> DataFrame:
    """Every value of a metric scaled to its range; a constant metric gives null.

    A metric key may own a third of all rows, so the rows are not shuffled by
    key: the ranges are aggregated on the map side, written, and joined back. The
    written table has one row per key and is broadcast when its size allows.
    """
    metrics = written(metrics, "metrics")  # read for the ranges and for the rows
    ranges = written(
        metrics.groupBy("key").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi")),
        "metric_ranges",
    )
    width = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    return metrics.join(ranges, "key").select(
        *metrics.columns, ((F.col("value") - F.col("_lo")) / width).alias("scaled")
    )


def minmax_wide(runs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dashboard form: an absent metric counts as 0, a constant column becomes 0."""
    filled = runs.na.fill(0.0, subset=list(columns))
    ranges = filled.agg(
        F.struct(
            *[F.min(c).alias(f"lo_{c}") for c in columns],
            *[F.max(c).alias(f"hi_{c}") for c in columns],
        )
    ).scalar()
    scaled = {}
    for c in columns:
        lo, hi = ranges[f"lo_{c}"], ranges[f"hi_{c}"]
        scaled[c] = F.coalesce((F.col(c) - lo) / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0))
    return filled.withColumns(scaled)


def running_successes(results: DataFrame, position: str, every: int = 5) -> DataFrame:
    """Successes so far at every `every`-th experiment, in `position` order."""
    good = (F.col("status") == "success").cast("bigint")
    totals = running_totals(results.select(position, "status"), [position], {"successes": good})
    return totals.where(F.col(position) % every == 0).select(position, "successes")


def metric_correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.agg(*[F.corr(a, b).alias(f"{a}_vs_{b}") for a, b in pairs])


def efficiency(runs: DataFrame, accuracy: str, time: str) -> DataFrame:
    """Accuracy per unit of time and time as a share of the longest."""
    longest = runs.agg(F.max(time)).scalar()
    return runs.withColumns(
        {
            "efficiency": F.try_divide(accuracy, time),
            "time_share": F.try_divide(F.col(time) * 100, longest),
        }
    )


def importance_stats(importances: DataFrame) -> DataFrame:
    return importances.agg(
        F.avg("importance").alias("mean_importance"), F.max("importance").alias("max_importance")
    )


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return folds.agg(F.avg("score").alias("cv_mean"), F.stddev_pop("score").alias("cv_std"))


def round_numbers(df: DataFrame, columns: Sequence[str], places: int = 4) -> DataFrame:
    return df.withColumns({c: scores.round_even(c, places) for c in columns})


def project_summary(models: DataFrame) -> DataFrame:
    order = F.struct(F.col("test_accuracy").isNull(), -F.col("test_accuracy"), F.col("run_id"))
    best = F.min_by("run_name", order)  # the lowest id wins ties, whatever its type
    return models.agg(
        F.count("*").alias("models"),
        F.avg("test_accuracy").alias("mean_accuracy"),
        best.alias("best_model"),
        F.max("test_accuracy").alias("best_accuracy"),
    )


def with_family(runs: DataFrame) -> DataFrame:
    return runs.withColumn("family", scores.algorithm_family("run_name"))
