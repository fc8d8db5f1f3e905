"""Monitoring and ingest as Structured Streaming jobs.

Each job reads files as they arrive and has a batch twin in the operators. The
trigger is `availableNow`: what is there is processed, then the job ends, and a
later call with the same checkpoint goes on from there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from foliospark.operators import monitor
from foliospark.sources import feed


#: What a finished query says of its micro-batches, oldest first.
Progress = list[dict[str, Any]]


def finish(writer: Any) -> Progress:
    """Start a query, wait for its end, raise what it raised, and return its progress."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return [dict(json.loads(p.json)) if hasattr(p, "json") else dict(p) for p in query.recentProgress]


def dropped_rows(progress: Progress) -> dict[str, int]:
    """Rows that came after the watermark and rows that were there before, over all micro-batches.

    Only of the first stateful operator: what it drops never reaches the others.
    """
    late = repeated = 0
    for batch in progress:
        states = batch.get("stateOperators") or []
        if states:
            first = states[-1]  # the plan is listed from its sink
            late += first.get("numRowsDroppedByWatermark", 0)
            repeated += (first.get("customMetrics") or {}).get("numDroppedDuplicateRows", 0)
    return {"late": late, "repeated": repeated}


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, source: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Files as they arrive, oldest first; with `max_files` at most so many to a micro-batch."""
    reader = spark.readStream.format(source).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def status_windows(
    statuses: DataFrame,
    out: str,
    checkpoint: str,
    delay: str = "1 hour",
    width: str = "5 minutes",
    key: str | None = None,
) -> Progress:
    """Status counts per window; every change of a window is appended with its batch.

    Rows that come after the watermark do not count; with `key`, a row that comes again
    counts once, and its key stays in the state until the watermark passes it. Update
    mode keeps the state to the windows that can still change; the reader
    `latest_windows` takes the newest row of each window.
    """
    seen = statuses.withWatermark("ts", delay)
    if key is not None:
        seen = seen.dropDuplicatesWithinWatermark([key])
    counted = monitor.status_windows(seen, "ts", width)

    def append(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch: a batch that is run again replaces its own rows
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out}/batch={batch_id:09d}"
        )

    return finish(
        counted.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append)
    )


def latest_windows(spark: SparkSession, out: str) -> DataFrame:
    """The last known counts of each window."""
    rows = spark.read.parquet(out).drop("batch")
    kept = [c for c in rows.columns if c not in ("window_start", "batch_id")]
    latest = rows.groupBy("window_start").agg(F.max_by(F.struct(*kept), "batch_id").alias("_last"))
    return latest.select("window_start", "_last.*")


def ingest_feed(spark: SparkSession, path: str, out: str, checkpoint: str) -> Progress:
    """New feed files become publication rows; a malformed entry costs only itself. No state."""
    pieces = spark.readStream.format("text").option("lineSep", feed.ENTRY_END).load(path)
    rows = feed.publications_from_entries(feed.entries_from_pieces(pieces))
    return finish(rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out))


STARTED, ALIVE, ENDED = "started", "alive", "ended"

#: Kinds in the order in which events of one moment count.
_KINDS = [STARTED, ALIVE, ENDED]
#: Groups that runs are dealt to by a hash of their id; a checkpoint holds as many.
_GROUPS = 1 << 8
_OPEN = "open binary"

#: Start and deadline of an open run in milliseconds; none for one that is not open.
_Kept = tuple[int, int] | None


def _follow(kept: _Kept, at: int, kind: int, limit: int) -> tuple[_Kept, _Kept]:
    """A run after an event, and what it is reported with if its time was up before that event.

    A start sets the deadline, a sign of life moves it, an end in time takes it away.
    """
    if kept is None:
        return ((at, at + limit) if kind == 0 else None), None
    if at > kept[1]:
        return None, kept
    if kind == 1:
        return (kept[0], max(kept[1], at + limit)), None
    return (None if kind == 2 else kept), None


def _watch(limit: int):
    """A function from the events of one run to its row when its time is up: the rule of `_watch_group` for a run alone."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else None
        late = []
        if state.hasTimedOut:
            late, kept = [kept], None
        else:
            events = [e for p in parts for e in zip(p["ms"].to_list(), p["kind"].to_list())]
            for at, kind in sorted(events):
                kept, reported = _follow(kept, at, kind, limit)
                if reported is not None:
                    late.append(reported)
            if kept is not None and kept[1] < state.getCurrentWatermarkMs():
                late.append(kept)
                kept = None
        if kept is not None:
            state.update(kept)
            state.setTimeoutTimestamp(kept[1])
        elif state.exists:
            state.remove()
        if late:
            yield pd.DataFrame({"run_id": [key[0]] * len(late), "started": [x[0] for x in late], "deadline": [x[1] for x in late]})

    return run


def _packed(runs: dict[int | None, tuple[int, int]]) -> bytes:
    return np.array([(k is not None, k or 0, *v) for k, v in runs.items()], np.int64).tobytes()


def _unpacked(held: bytes) -> dict[int | None, tuple[int, int]]:
    rows = np.frombuffer(held, np.int64).reshape(-1, 4).tolist()
    return {run if known else None: (started, deadline) for known, run, started, deadline in rows}


def _watch_group(limit: int):
    """A function from a group's events of a micro-batch to the rows of its runs whose time is up.

    The state is the start and the deadline of each open run of the group, its timeout the first
    of the deadlines.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        runs = _unpacked(state.get[0]) if state.exists else {}
        late = []
        if not state.hasTimedOut:
            columns = zip(*([p[c].to_numpy() for c in ("run_id", "known", "ms", "kind")] for p in parts))
            ids, known, ms, kinds = map(np.concatenate, columns)
            order = np.lexsort((kinds, ms))
            of = ids[order].tolist() if known.all() else np.where(known, ids, None)[order].tolist()
            for k, at, kind in zip(of, ms[order].tolist(), kinds[order].tolist()):
                before = runs.get(k)
                kept, reported = _follow(before, at, kind, limit)
                if reported is not None:
                    late.append((k, *reported))
                if kept is not None:
                    runs[k] = kept
                elif before is not None:
                    del runs[k]
        passed = state.getCurrentWatermarkMs()
        for k in [k for k, kept in runs.items() if kept[1] < passed]:
            late.append((k, *runs.pop(k)))
        if runs:
            state.update((_packed(runs),))
            state.setTimeoutTimestamp(min(deadline for _, deadline in runs.values()))
        elif state.exists:
            state.remove()
        if late:
            found = zip(*late)
            yield pd.DataFrame({c: pd.array(v, "Int64") for c, v in zip(("run_id", "started", "deadline"), found)})

    return run


def watch_timeouts(
    events: DataFrame, max_hours: float, out: str, checkpoint: str, delay: str = "1 hour"
) -> Progress:
    """Runs that show no end and no sign of life for `max_hours`, each reported once.

    `events(run_id long, ts, kind)` with the kinds started, alive and ended. A run is
    reported when the watermark passes its deadline or a later event of it comes, and
    then forgotten; a run that ends in time leaves the state with its end. Events of
    unknown runs, without a time and those that come after the watermark change nothing. Runs are
    dealt to _GROUPS groups, so that a call, a state and a timeout serve all events and open runs of a
    group. The state of a group is one row of its open runs, kept in RocksDB, with their first
    deadline as its timeout. It comes to Python and goes back beside the events.
    """
    spark = events.sparkSession
    known = events.where(F.col("kind").isin(_KINDS) & F.col("ts").isNotNull()).withWatermark("ts", delay)
    place = F.array_position(F.array(*map(F.lit, _KINDS)), F.col("kind")) - 1
    numbered = known.select(
        F.pmod(F.xxhash64("run_id"), F.lit(_GROUPS)).cast("int").alias("group"),
        F.coalesce("run_id", F.lit(0).cast("long")).alias("run_id"), F.col("run_id").isNotNull().alias("known"),
        "ts", F.unix_millis("ts").alias("ms"), place.cast("int").alias("kind"),
    )
    late = numbered.groupBy("group").applyInPandasWithState(
        _watch_group(int(max_hours * 3_600_000)),
        "run_id long, started long, deadline long",
        _OPEN,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    reported = late.select("run_id", *[F.timestamp_millis(c).alias(c) for c in ("started", "deadline")])
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return finish(
            reported.writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", checkpoint)
            .option("path", out)
        )
    finally:
        spark.conf.set(provider, before)


def append_snapshots(statuses: DataFrame, out: str, checkpoint: str) -> Progress:
    """One snapshot of the status counts per micro-batch, appended to a table."""

    def append(batch: DataFrame, batch_id: int) -> None:
        snapshot = monitor.status_counts(batch).withColumn("snapshot", F.lit(batch_id))
        snapshot.write.mode("overwrite").parquet(f"{out}/batch={batch_id:09d}")

    return finish(statuses.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append))
