"""Result files: one directory per experiment with metrics and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.schemas import EXPERIMENT_RESULT
from foliospark.sources import manifest

# File names inside an experiment directory.
RESULT_FILE = r"([^/]+)/metrics\.json$"
METADATA_FILE = r"([^/]+)/model_metadata\.yaml$"
SCALAR_LINE = r"(?m)^([A-Za-z_]\w*):[ \t]+(\S.*?)[ \t\r]*$"


def read_files(spark: SparkSession, root: str | list[str] | DataFrame) -> DataFrame:
    """Rows `(path, content)` of all result and metadata files under a folder, or of those named."""
    if isinstance(root, DataFrame):
        files = manifest.contents(root)
    else:
        files = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
        files = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    path = F.col("path")
    return files.where(path.rlike(RESULT_FILE) | path.rlike(METADATA_FILE))


def results(files: DataFrame) -> DataFrame:
    """The nested metrics of each experiment as flat columns; a missing one is null."""
    parsed = files.where(F.col("path").rlike(RESULT_FILE)).select(
        F.regexp_extract("path", RESULT_FILE, 1).alias("run_name"),
        F.from_json("content", EXPERIMENT_RESULT).alias("r"),
    )
    return parsed.select(
        "run_name",
        F.col("r.cross_validation.mean_score").alias("metric_cv_mean_score"),
        F.col("r.cross_validation.std_score").alias("metric_cv_std_score"),
        F.col("r.cross_validation.scores").alias("metric_cv_scores"),
        *[
            F.col(f"r.test_metrics.{m}").alias(f"metric_test_{m}")
            for m in EXPERIMENT_RESULT["test_metrics"].dataType.names
        ],
        *[F.col(f"r.model_info.{m}").alias(m) for m in EXPERIMENT_RESULT["model_info"].dataType.names],
        F.col("r.training_date").alias("training_date"),
    )


def metadata(files: DataFrame) -> DataFrame:
    """Rows `(run_name, key, value)` of the top-level scalar lines."""
    found = files.where(F.col("path").rlike(METADATA_FILE))
    keys = F.regexp_extract_all("content", F.lit(SCALAR_LINE), F.lit(1))
    values = F.regexp_extract_all("content", F.lit(SCALAR_LINE), F.lit(2))
    pairs = F.arrays_zip(keys.alias("key"), values.alias("value"))
    rows = found.select(
        F.regexp_extract("path", METADATA_FILE, 1).alias("run_name"), F.explode(pairs).alias("p")
    )
    bare = F.regexp_replace("p.value", r"""^(['"])(.*)\1$""", "$2")
    return rows.select("run_name", F.col("p.key").alias("key"), bare.alias("value"))
