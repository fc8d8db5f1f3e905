"""Dataset profiles. Each profile is one pass: all statistics in one `agg`."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _total(columns: list[Column]) -> Column:
    return reduce(add, columns, F.lit(0).cast("bigint"))


def _null_cells(df: DataFrame) -> Column:
    return _total([F.count_if(F.col(c).isNull()) for c in df.columns])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def dataset_profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_papers"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def category_counts(df: DataFrame, column: str = "arxiv_categories") -> DataFrame:
    """Publications per category of the comma list."""
    exploded = df.where(F.col(column) != "").select(
        F.explode(F.split(column, ", ")).alias("category")
    )
    return exploded.groupBy("category").agg(F.count("*").alias("n"))


def top_categories(df: DataFrame, column: str = "arxiv_categories", k: int = 10) -> DataFrame:
    return category_counts(df, column).orderBy(F.desc("n"), "category").limit(k)


def completeness_truthy(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null, non-empty cells per column."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & (F.col(c) != "")).alias(c) for c in columns])


def completeness_ratio(df: DataFrame) -> DataFrame:
    """Non-null cells over all cells, with the shape."""
    filled = _total([F.count(c) for c in df.columns])
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.try_divide(filled, F.count("*") * len(df.columns)).alias("completeness"),
    )


def frame_profile(df: DataFrame) -> DataFrame:
    """Shape, missing cells and the averages of column means and sample spreads."""
    numeric = numeric_columns(df)
    width = max(len(numeric), 1)
    # a column without values has no mean: it must not count in the average
    means = [F.avg(c) for c in numeric]
    spreads = [F.stddev_samp(c) for c in numeric]

    def mean_of(parts: list[Column]) -> Column:
        present = _total([p.isNotNull().cast("bigint") for p in parts])
        return F.try_divide(reduce(add, [F.coalesce(p, F.lit(0.0)) for p in parts], F.lit(0.0)), present)

    nulls = _null_cells(df)
    columns = [
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        nulls.alias("missing_values"),
        F.try_divide(nulls * 100, F.count("*") * len(df.columns)).alias("missing_percentage"),
        F.lit(len(numeric)).alias("numeric_columns"),
    ]
    if numeric:
        columns += [mean_of(means).alias("mean_of_means"), mean_of(spreads).alias("mean_of_stds")]
    return df.agg(*columns)


def column_types(df: DataFrame) -> DataFrame:
    """Columns per data type, from the schema alone."""
    counts: dict[str, int] = {}
    for _, kind in df.dtypes:
        counts[kind] = counts.get(kind, 0) + 1
    return df.sparkSession.createDataFrame(sorted(counts.items()), "dtype string, n_columns int")


def training_profile(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("samples"),
        F.lit(len(df.columns) - 1).alias("features"),
        F.count_distinct(target).alias("classes"),
        _null_cells(df).alias("missing_values"),
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(F.col(target).alias("target")).agg(F.count("*").alias("n"))
