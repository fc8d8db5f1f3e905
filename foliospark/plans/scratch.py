"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a fresh local one only in local mode."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="foliospark-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/foliospark/{uuid.uuid4().hex}/{label}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage at a place that survives lost executors, computes an
    aggregate that several branches need only once, and gives Catalyst its true
    size: a join broadcasts the table when that size is under
    `spark.sql.autoBroadcastJoinThreshold` and shuffles otherwise.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
