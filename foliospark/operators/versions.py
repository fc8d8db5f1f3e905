"""Model versions: latest, stages, numbering, comparison with a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.plans.ordering import running_totals

# The stage an archived version ends in.
ARCHIVED = "Archived"


def latest_versions(versions: DataFrame) -> DataFrame:
    """Highest version number per name and stage."""
    return versions.groupBy("name", "stage").agg(F.max("version").alias("version"))


def latest_model_lookup(names: DataFrame, versions: DataFrame) -> DataFrame:
    """Metrics of the latest version of each requested name; unknown names are skipped.

    Versions are reduced to one row per name on the map side before the join.
    """
    measured = [c for c in versions.columns if c not in ("name", "version")]
    latest = versions.groupBy("name").agg(
        F.max("version").alias("version"),
        F.max_by(F.struct(*measured), "version").alias("_latest"),
    )
    return names.select("name").join(latest, "name").select("name", "version", "_latest.*")


def stage_after_events(events: DataFrame) -> DataFrame:
    """Current stage of each version from `(name, version, stage, ts, archive_existing)`.

    A version holds the stage of its own last event, unless a later event moved
    another version into that stage and asked to archive the ones already there.
    """
    own = events.groupBy("name", "version").agg(
        F.max_by("stage", "ts").alias("stage"), F.max("ts").alias("ts")
    )
    swept = (
        events.where("archive_existing").groupBy("name", "stage").agg(F.max("ts").alias("_swept"))
    )
    archived = F.col("_swept") > F.col("ts")
    return own.join(swept, ["name", "stage"], "left").select(
        "name", "version", F.when(archived, ARCHIVED).otherwise(F.col("stage")).alias("stage")
    )


def next_version(versions: DataFrame) -> DataFrame:
    """Existing versions per name, and the number the next one gets."""
    return versions.groupBy("name").agg(
        F.count("*").alias("existing"), (F.count("*") + 1).alias("next_version")
    )


def number_versions(registrations: DataFrame, order: str = "registered") -> DataFrame:
    """Version numbers 1, 2, ... per name by registration order, for a whole batch."""
    return running_totals(registrations, [order], {"version": F.lit(1).cast("bigint")}, ["name"])


def baseline_delta(current: DataFrame, baselines: DataFrame) -> DataFrame:
    """Accuracy minus that of the run named as baseline; a missing baseline counts as 0."""
    base = baselines.select(
        F.col("run_id").alias("baseline_id"), F.col("test_accuracy").alias("_base")
    )
    known = F.coalesce("_base", F.lit(0.0))
    return current.join(base, "baseline_id", "left").select(
        "run_id",
        "baseline_id",
        known.alias("baseline_accuracy"),
        (F.coalesce("test_accuracy", F.lit(0.0)) - known).alias("accuracy_improvement"),
    )
