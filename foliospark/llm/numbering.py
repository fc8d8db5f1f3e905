"""Numbers without gaps for the rows of each group, though no task holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 12


def numbered(rows: DataFrame, by: str, row: str, name: str) -> DataFrame:
    """Add `name`: 0, 1, ... within each value of `by`, in the order of the unique long `row`.

    `row` must be stored with the rows (monotonically_increasing_id, written). Blocks
    of consecutive rows are numbered on their own and start from the count of the
    blocks before.
    """
    blocked = rows.withColumn("_block", F.shiftright(row, BLOCK_BITS))
    earlier = Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy(by, "_block")
        .agg(F.count("*").alias("_n"))
        .select(by, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(by, "_block").orderBy(row)
    return (
        blocked.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, [by, "_block"])
        .select(*rows.columns, (F.col("_start") + F.col("_at")).alias(name))
    )
