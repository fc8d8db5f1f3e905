"""Status, activity and timeout monitoring in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import scores
from pyspark.sql.window import Window

# Statuses that count, and the alert limits.
STATUSES = ["completed", "failed", "running", "stopped"]
SHARED_STATUSES = ["completed", "failed"]
MIN_SUCCESS_RATE = 80
MAX_RUNNING = 5


def status_aggregates() -> list[Column]:
    """Counts per status, their total, and the success rate in percent to 2 places."""
    total = F.count_if(F.col("status").isin(STATUSES))
    done = F.count_if(F.col("status") == "completed")
    rate = F.coalesce(scores.round_even(F.try_divide(done, total) * 100, 2), F.lit(0.0))
    return [
        total.alias("total_tasks"),
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        rate.alias("success_rate"),
    ]


def status_counts(statuses: DataFrame) -> DataFrame:
    return statuses.agg(*status_aggregates())


def status_windows(statuses: DataFrame, ts: str = "ts", width: str = "5 minutes") -> DataFrame:
    """Status counts per tumbling window; the same plan serves batch and streams."""
    return (
        statuses.groupBy(F.window(ts, width).alias("_w"))
        .agg(*status_aggregates())
        .select(F.col("_w.start").alias("window_start"), "*")
        .drop("_w")
    )


def status_share(statuses: DataFrame) -> DataFrame:
    """Count and percent of completed and failed."""
    counts = (
        statuses.where(F.col("status").isin(SHARED_STATUSES))
        .groupBy("status")
        .agg(F.count("*").alias("n"))
    )
    whole = F.sum("n").over(Window.partitionBy(F.lit(1)))  # at most two rows
    return counts.select("status", "n", (F.col("n") * 100 / whole).alias("percent"))


def daily_activity(runs: DataFrame, created: str = "created") -> DataFrame:
    dated = runs.where(F.col(created).isNotNull())
    return dated.groupBy(F.to_date(created).alias("day")).agg(F.count("*").alias("n"))


def overview(runs: DataFrame, newest: int = 50) -> DataFrame:
    """Totals and success percent of the newest completed or failed runs."""
    recent = (
        runs.where(F.col("status").isin(SHARED_STATUSES))
        .orderBy(F.col("created").desc_nulls_last(), "run_id")
        .limit(newest)
    )
    done = F.count_if(F.col("status") == "completed")
    return recent.agg(
        F.count("*").alias("total_experiments"),
        done.alias("completed"),
        F.coalesce(F.try_divide(done, F.count("*")) * 100, F.lit(0.0)).alias("success_percent"),
        F.avg(F.when(F.col("runtime_min") > 0, F.col("runtime_min"))).alias("average_runtime_min"),
    )


def stage_summary(stages: DataFrame) -> DataFrame:
    return stages.agg(
        F.count("*").alias("total_stages"),
        F.count_if(F.col("status") == "completed").alias("completed"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "running").alias("running"),
        F.coalesce(F.sum(F.coalesce("duration", F.lit(0.0))), F.lit(0.0)).alias("total_duration"),
    )


def history(snapshots: DataFrame, order: str, keep: int = 50) -> DataFrame:
    """The newest snapshots."""
    return snapshots.orderBy(F.desc(order)).limit(keep)


def alerts(snapshots: DataFrame) -> DataFrame:
    """One row per snapshot and alert; a healthy snapshot says so."""
    low = F.when(F.col("success_rate") < MIN_SUCCESS_RATE, F.lit("low success rate"))
    busy = F.when(F.col("running") > MAX_RUNNING, F.lit("many tasks running at once"))
    raised = F.array_compact(F.array(low, busy))
    shown = F.when(F.size(raised) > 0, raised).otherwise(F.array(F.lit("system is healthy")))
    kept = [c for c in ("window_start",) if c in snapshots.columns]
    return snapshots.select(*kept, F.explode(shown).alias("alert"))


def timeouts(runs: DataFrame, now: Column, max_hours: float) -> DataFrame:
    """Runs without an end that have been open longer than `max_hours`."""
    limit = F.make_dt_interval(hours=F.lit(int(max_hours)), mins=F.lit(int(max_hours % 1 * 60)))
    return runs.where(F.col("completed").isNull() & (now - F.col("created") > limit))
