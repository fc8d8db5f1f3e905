"""Run directories to `runs`, `params`, `metrics` and `tags` tables.

Layout: `<root>/<experiment>/<run>/meta.yaml` and, beside it, one file per key
in `params`, `metrics` and `tags`. A metric file has one `ts value step` line
per report; `<root>/<experiment>/meta.yaml` names the experiment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.functions.text import WHITESPACE_RUN, strip_whitespace
from foliospark.sources import manifest

# Where the parts of the layout are in a path.
RUN_META = r"([^/]+)/([^/]+)/meta\.yaml$"
KEY_FILE = r"([^/]+)/([^/]+)/(params|metrics|tags)/(.+)$"


def read_files(spark: SparkSession, root: str | list[str] | DataFrame) -> DataFrame:
    """Rows `(path, content)` of the files that belong to the layout; artefacts are skipped.

    `root` is a folder, or the files that have changed since the last read, as paths or a table of them.
    """
    if isinstance(root, DataFrame):
        files = manifest.contents(root)
    else:
        files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
        files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    path = F.col("path")
    return files.where(path.rlike(RUN_META) | path.rlike(KEY_FILE))


def yaml_value(key: str) -> Column:
    """Value of a top-level `key: value` line without its quotes; null when absent."""
    found = F.regexp_extract("content", rf"(?m)^{key}:[ \t]*(.*?)[ \t\r]*$", 1)
    bare = F.regexp_replace(found, r"""^(['"])(.*)\1$""", "$2")
    return F.when((bare != "") & ~bare.isin("null", "~"), bare)


def runs(files: DataFrame) -> DataFrame:
    has_run = files.where(F.col("path").rlike(RUN_META) & yaml_value("run_id").isNotNull())
    return has_run.select(
        yaml_value("run_id").alias("run_id"),
        yaml_value("experiment_id").alias("experiment_id"),
        yaml_value("run_name").alias("run_name"),
        yaml_value("status").try_cast("int").alias("status"),
        yaml_value("start_time").try_cast("bigint").alias("start_time"),
        yaml_value("end_time").try_cast("bigint").alias("end_time"),
        yaml_value("lifecycle_stage").alias("lifecycle_stage"),
    )


def experiments(files: DataFrame) -> DataFrame:
    meta = files.where(F.col("path").rlike(RUN_META) & yaml_value("run_id").isNull())
    return meta.select(
        yaml_value("experiment_id").alias("experiment_id"), yaml_value("name").alias("experiment_name")
    ).where(F.col("experiment_id").isNotNull())


def _keyed(files: DataFrame, kind: str) -> DataFrame:
    part = {i: F.regexp_extract("path", KEY_FILE, i) for i in (2, 3, 4)}
    return files.where(part[3] == kind).select(part[2].alias("run_id"), part[4].alias("key"), "content")


def params(files: DataFrame) -> DataFrame:
    return _keyed(files, "params").select("run_id", "key", F.col("content").alias("value"))


def tags(files: DataFrame) -> DataFrame:
    return _keyed(files, "tags").select("run_id", "key", F.col("content").alias("value"))


def metrics(files: DataFrame) -> DataFrame:
    """One row per report of a metric; a line that is no report is left out."""
    lines = _keyed(files, "metrics").select(
        "run_id", "key", F.explode(F.split("content", r"\r?\n")).alias("line")
    )
    fields = F.split(strip_whitespace("line"), WHITESPACE_RUN)
    parsed = lines.select(
        "run_id",
        "key",
        F.get(fields, F.lit(0)).try_cast("bigint").alias("ts"),
        F.get(fields, F.lit(1)).try_cast("double").alias("value"),
        F.coalesce(F.get(fields, F.lit(2)).try_cast("int"), F.lit(0)).alias("step"),
    )
    return parsed.where(F.col("ts").isNotNull() & F.col("value").isNotNull())


def runtime_seconds(runs_table: DataFrame) -> DataFrame:
    seconds = (F.col("end_time") - F.col("start_time")) / 1000
    return runs_table.withColumn("runtime_sec", seconds)
