"""CSV and JSON tables with fixed schemas, and one-row profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.schemas import PUBLICATION, null_missing_tokens


def read_csv(spark: SparkSession, path: str, schema: T.StructType = PUBLICATION) -> DataFrame:
    """Header CSV with quoted multi-line text; missing-value spellings become null.

    A file with line breaks inside quotes cannot be split, so large tables
    should come as many files, as `write_csv` makes them.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .schema(schema)
        .csv(path)
    )
    return null_missing_tokens(raw)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Fixed columns with a header; arrays, maps and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    chosen = df.select(*(columns or df.columns))
    flat = chosen.select(
        *[
            F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in chosen.schema.fields
        ]
    )
    flat.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines; nulls kept."""
    df.write.option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_profile(profile: DataFrame, path: str) -> None:
    """A one-row profile as a single JSON file beside the data."""
    profile.coalesce(1).write.mode("overwrite").json(path)
