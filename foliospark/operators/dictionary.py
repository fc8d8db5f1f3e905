"""Dictionaries of any size: levels ranked over ranges, joined back, one-hot vectors in rows.

Nothing is collected. Distinct levels are sorted by ranges; a level's number is its
place in its range after the levels of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.plans.scratch import written

_IN_RANGE = (1 << 33) - 1


def fit_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Rows `(level, index)`: the distinct non-null values numbered 0, 1, ... in sorted order.

    One shuffle for the distinct values and one to sort them; a table in the shared
    folder, so that its size decides how it is joined. An empty table has no levels.
    """
    levels = df.select(F.col(column).alias("level")).where(F.col("level").isNotNull()).distinct()
    placed = written(
        levels.repartitionByRange("level")
        .sortWithinPartitions("level")
        .withColumn("place", F.monotonically_increasing_id()),
        "levels",
    )
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each range
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    index = F.col("start") + F.col("place").bitwiseAND(_IN_RANGE)
    return written(
        placed.withColumn("part", part).join(starts, "part").select("level", index.alias("index")), "dictionary"
    )


def encode(df: DataFrame, dictionary: DataFrame, column: str, output: str = "label") -> DataFrame:
    """Add the number of the column's level; null for null and for a level that is not known."""
    known = dictionary.select(F.col("level").alias("_level"), F.col("index").alias(output))
    return df.join(known, F.col(column) == F.col("_level"), "left").drop("_level")


def one_hot_vector(index: Column, size: Column) -> Column:
    """Sparse vector of a level as struct(size, indices, values); all zero for null."""
    known = index.isNotNull()
    return F.struct(
        size.cast("long").alias("size"),
        F.when(known, F.array(index)).otherwise(F.array().cast("array<bigint>")).alias("indices"),
        F.when(known, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )


def one_hot_sparse(df: DataFrame, dictionary: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Add the one-hot vector of a column with any number of levels, made inside the row."""
    coded = encode(df, dictionary, column, "_index")
    size = dictionary.agg(F.count("*")).scalar()
    return coded.withColumn(output or f"{column}_vector", one_hot_vector(F.col("_index"), size)).drop("_index")
