"""Streaming queries: each runs the stream to its end and reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import monitor
from foliospark.plans.scratch import new_path, written
from foliospark.queries import views
from foliospark.queries.monitoring import _WINDOW_COLUMNS
from foliospark.queries.registry import query
from foliospark.queries.sources import PLAIN_FEED_SQL, written_feed
from foliospark.queries.views import with_views
from foliospark.schemas import PUBLICATION
from foliospark.streaming import jobs


_SLICES, _FILES = 6, 4
_DELAY = "1 day"


def _slice(ts, low, high):
    """Number of the equal stretch of time that holds a row."""
    part = (F.unix_micros(ts) - F.unix_micros(low)) / (F.unix_micros(high) - F.unix_micros(low) + 1)
    return F.floor(part * _SLICES).cast("int")


def _in_order(spark, df, label, ts="ts", extra=None, only=range(_SLICES), path=None):
    """Write a table as files in the order of its times, a slice after the other.

    `extra` maps a slice to rows that arrive right behind it. Every slice, and every
    addition, has as many files as a micro-batch takes.
    """
    path = path or new_path(spark, label)
    low, high = df.agg(F.min(ts), F.max(ts)).first()
    for k in only:
        some = df.where(_slice(F.col(ts), F.lit(low), F.lit(high)) == k)
        some.repartition(_FILES).write.mode("append").parquet(path)
        if extra and k in extra:
            extra[k].repartition(_FILES).write.mode("append").parquet(path)
    return path


def _statuses(spark, folder):
    statuses = views.statuses(spark, folder)
    return statuses.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "status")


def _status_stream(spark, path, like):
    return jobs.read_stream(spark, path, like.schema, max_files=_FILES)


def _with_late_and_repeated(spark, folder):
    """Statuses over several micro-batches, some of them twice, and new ones that come far too late."""
    rows = _statuses(spark, folder)
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    at = _slice(F.col("ts"), F.lit(low), F.lit(high))
    repeated = rows.where((at == 3) & (F.col("event_id") % 4 == 0))
    late = rows.where((at == 0) & (F.col("event_id") % 5 == 0))
    late = late.withColumn("event_id", -F.col("event_id") - 1)
    path = _in_order(spark, rows, "statuses", extra={3: repeated, _SLICES - 1: late})
    return _status_stream(spark, path, rows)


@query(
    "stream_status_windows",
    with_views("status_windows", f"SELECT w AS window_start, {_WINDOW_COLUMNS} FROM status_windows"),
)
def _(spark, folder):
    """What comes twice or too late changes no window."""
    out = new_path(spark, "windows")
    stream = _with_late_and_repeated(spark, folder)
    jobs.status_windows(stream, out, new_path(spark, "checkpoint"), _DELAY, key="event_id")
    latest = jobs.latest_windows(spark, out)
    return latest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "stream_dropped_rows",
    with_views(
        "statuses",
        f""", edge AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM statuses),
             placed AS (SELECT event_id, floor((epoch_us(ts) - low) / (high - low + 1)::DOUBLE * {_SLICES}) AS part
                        FROM statuses, edge)
           SELECT {_SLICES + 2} AS batches, count(*) FILTER (part = 3 AND event_id % 4 = 0)
                  + count(*) FILTER (part = 0 AND event_id % 5 = 0) AS dropped FROM placed""",
    ),
)
def _(spark, folder):
    """Micro-batches with rows, and the rows that came twice or after the watermark."""
    stream = _with_late_and_repeated(spark, folder)
    out, checkpoint = new_path(spark, "windows"), new_path(spark, "checkpoint")
    progress = jobs.status_windows(stream, out, checkpoint, _DELAY, key="event_id")
    batches = sum(p["numInputRows"] > 0 for p in progress)
    dropped = sum(jobs.dropped_rows(progress).values())
    return spark.createDataFrame([(batches, dropped)], "batches int, dropped long")


@query(
    "stream_snapshots",
    with_views(
        "statuses",
        f"""SELECT {_SLICES} AS snapshots, count(*) FILTER (status <> 'queued') AS total_tasks,
                  count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed,
                  count(*) FILTER (status = 'running') AS running, count(*) FILTER (status = 'stopped') AS stopped
           FROM statuses""",
    ),
)
def _(spark, folder):
    """A snapshot for each micro-batch, the newest fifty read back."""
    out, rows = new_path(spark, "snapshots"), _statuses(spark, folder)
    stream = _status_stream(spark, _in_order(spark, rows, "statuses"), rows)
    jobs.append_snapshots(stream, out, new_path(spark, "checkpoint"))
    kept = monitor.history(spark.read.parquet(out), "snapshot", 50)
    return kept.groupBy().agg(
        F.count("*").cast("int").alias("snapshots"),
        *[F.sum(c).alias(c) for c in ("total_tasks", "completed", "failed", "running", "stopped")],
    )


@query("stream_ingest", PLAIN_FEED_SQL)
def _(spark, folder):
    out = new_path(spark, "publications")
    jobs.ingest_feed(spark, written_feed(spark, folder), out, new_path(spark, "checkpoint"))
    return spark.read.schema(PUBLICATION).parquet(out)


_MAX_HOURS = 24 * 60

# a run that shows life a month after its start has its deadline moved by as much
_ALIVE_DAYS = 30


@query(
    "stream_timeouts",
    with_views(
        "runs",
        f""", events AS (
               SELECT created AS ts FROM runs
               UNION ALL SELECT created + INTERVAL {_ALIVE_DAYS} DAY FROM runs WHERE run_id % 4 = 0
               UNION ALL SELECT completed FROM runs WHERE completed IS NOT NULL),
             edge AS (SELECT max(ts) - INTERVAL 1 DAY AS watermark FROM events),
             due AS (
               SELECT run_id, created AS started, created + INTERVAL {_MAX_HOURS} HOUR
                      + CASE WHEN run_id % 4 = 0 AND (completed IS NULL OR completed >= created
                                                      + INTERVAL {_ALIVE_DAYS} DAY)
                             THEN INTERVAL {_ALIVE_DAYS} DAY ELSE INTERVAL 0 DAY END AS deadline, completed
               FROM runs)
           SELECT run_id, started, deadline FROM due, edge
           WHERE completed > deadline OR (completed IS NULL AND deadline < watermark)""",
    ),
)
def _(spark, folder):
    """Starts, signs of life and ends over six micro-batches, the stream stopped and resumed in between."""
    runs = views.runs(spark, folder)
    events = runs.select(
        "run_id",
        F.inline(
            F.array_compact(
                F.array(
                    F.struct(F.col("created").cast("timestamp").alias("ts"), F.lit(jobs.STARTED).alias("kind")),
                    F.when(
                        F.col("run_id") % 4 == 0,
                        F.struct(
                            (F.col("created") + F.expr(f"INTERVAL {_ALIVE_DAYS} DAYS")).cast("timestamp").alias("ts"),
                            F.lit(jobs.ALIVE).alias("kind"),
                        ),
                    ),
                    F.when(
                        F.col("completed").isNotNull(),
                        F.struct(F.col("completed").cast("timestamp").alias("ts"), F.lit(jobs.ENDED).alias("kind")),
                    ),
                )
            )
        ),
    )
    events = written(events, "run_events")
    out, checkpoint, path = (new_path(spark, x) for x in ("timeouts", "checkpoint", "events"))
    half = _SLICES // 2
    for part in (range(half), range(half, _SLICES)):
        _in_order(spark, events, "events", only=part, path=path)
        stream = jobs.read_stream(spark, path, events.schema, max_files=_FILES)
        jobs.watch_timeouts(stream, _MAX_HOURS, out, checkpoint, _DELAY)
    late = spark.read.schema("run_id long, started timestamp, deadline timestamp").parquet(out)
    return late.select(
        "run_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "deadline")]
    )
