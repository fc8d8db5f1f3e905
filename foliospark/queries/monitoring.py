"""Queries over statuses, stages and activity."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import monitor
from foliospark.queries import views
from foliospark.queries.registry import query
from foliospark.queries.views import table, with_views

_WINDOW_COLUMNS = "total_tasks, completed, failed, running, stopped, success_rate"


@query(
    "status_counts",
    with_views(
        "statuses",
        """SELECT total_tasks, completed, failed, running, stopped,
                  coalesce(round_even(completed / nullif(total_tasks, 0) * 100, 2), 0) AS success_rate FROM (
             SELECT count(*) FILTER (status <> 'queued') AS total_tasks,
                    count(*) FILTER (status = 'completed') AS completed,
                    count(*) FILTER (status = 'failed') AS failed,
                    count(*) FILTER (status = 'running') AS running,
                    count(*) FILTER (status = 'stopped') AS stopped FROM statuses)""",
    ),
)
def _(spark, folder):
    return monitor.status_counts(views.statuses(spark, folder))


@query(
    "status_share",
    with_views(
        "runs",
        """SELECT status, count(*) AS n, count(*) * 100 / (sum(count(*)) OVER ())::DOUBLE AS percent
           FROM runs WHERE status IN ('completed', 'failed') GROUP BY 1""",
    ),
)
def _(spark, folder):
    return monitor.status_share(views.runs(spark, folder))


@query("daily_activity", with_views("runs", "SELECT created::DATE AS day, count(*) AS n FROM runs GROUP BY 1"))
def _(spark, folder):
    return monitor.daily_activity(views.runs(spark, folder))


@query(
    "overview",
    with_views(
        "runs",
        """SELECT count(*) AS total_experiments, count(*) FILTER (status = 'completed') AS completed,
                  count(*) FILTER (status = 'completed') / count(*)::DOUBLE * 100 AS success_percent,
                  round(avg(CASE WHEN runtime_min > 0 THEN runtime_min END), 6) AS average_runtime_min
           FROM (SELECT * FROM runs WHERE status IN ('completed', 'failed') ORDER BY created DESC, run_id LIMIT 50)""",
    ),
)
def _(spark, folder):
    seen = monitor.overview(views.runs(spark, folder))
    return seen.withColumn("average_runtime_min", F.round("average_runtime_min", 6))


@query(
    "stage_summary",
    with_views(
        "runs",
        """SELECT count(*) AS total_stages, count(*) FILTER (status = 'completed') AS completed,
                  count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'running') AS running,
                  sum(coalesce(runtime_min, 0)) AS total_duration FROM runs""",
    ),
)
def _(spark, folder):
    return monitor.stage_summary(views.runs(spark, folder).withColumnRenamed("runtime_min", "duration"))


@query(
    "status_windows",
    with_views("status_windows", f"SELECT w AS window_start, {_WINDOW_COLUMNS} FROM status_windows"),
)
def _(spark, folder):
    return monitor.status_windows(views.statuses(spark, folder))


@query(
    "history_last_50",
    with_views(
        "status_windows",
        f"SELECT w AS window_start, {_WINDOW_COLUMNS} FROM status_windows ORDER BY w DESC LIMIT 50",
    ),
)
def _(spark, folder):
    return monitor.history(monitor.status_windows(views.statuses(spark, folder)), "window_start")


@query(
    "alerts",
    with_views(
        "status_windows",
        """SELECT w AS window_start, 'low success rate' AS alert FROM status_windows WHERE success_rate < 80
           UNION ALL SELECT w, 'many tasks running at once' FROM status_windows WHERE running > 5
           UNION ALL SELECT w, 'system is healthy' FROM status_windows WHERE success_rate >= 80 AND running <= 5""",
    ),
)
def _(spark, folder):
    return monitor.alerts(monitor.status_windows(views.statuses(spark, folder)))


@query(
    "timeouts",
    with_views(
        "runs",
        """SELECT run_id, created FROM runs
           WHERE completed IS NULL AND TIMESTAMP '2001-08-01' - created > INTERVAL 2000 HOUR""",
    ),
)
def _(spark, folder):
    open_runs = monitor.timeouts(
        views.runs(spark, folder), F.lit("2001-08-01").cast("timestamp_ntz"), 2000
    )
    return open_runs.select("run_id", "created")
