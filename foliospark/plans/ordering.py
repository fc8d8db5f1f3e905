"""Exact running totals, ranks and medians that no single task has to hold.

A window over a whole group puts the group into one task. Here the order is
first cut into ranges of about equal size; each range is its own window
partition and starts from the total of the ranges before it. A key that owns a
third of all rows is therefore spread over all ranges. Rows without a key form a
group of their own, and rows without an order value come last in their group, for
any number of ranges.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliospark.plans.scratch import written

_RANGE = "_range"
_CUT = "_cut"


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which a null equals a null; the keys come from the left side."""
    named = {k: f"_right_{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(named)
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(r)) for k, r in named.items()])
    return left.join(right, same, how).drop(*named.values())


def _with_range(df: DataFrame, order: str, ranges: int | None) -> DataFrame:
    """Add the number of the value range that holds the row's order value, nulls in the last."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn(_CUT, F.col(order).cast("double"))
    probabilities = [i / ranges for i in range(1, ranges)]
    found = keyed.approxQuantile(_CUT, probabilities, 1 / (4 * ranges)) if probabilities else []
    edges = [float("-inf"), *sorted(set(found)), float("inf")]
    if len(edges) < 3:
        place = F.when(F.col(_CUT).isNull(), 1.0).otherwise(0.0)
        return keyed.withColumn(_RANGE, place).drop(_CUT)
    cutter = Bucketizer(splits=edges, inputCol=_CUT, outputCol=_RANGE, handleInvalid="keep")
    last = F.coalesce(F.col(_RANGE), F.lit(float(len(edges))))
    return cutter.transform(keyed).withColumn(_RANGE, last).drop(_CUT)


def running_totals(
    df: DataFrame,
    order_by: list[str],
    sums: dict[str, Column],
    keys: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add inclusive running sums in `order_by` order within each key.

    The first order column must be numeric; `order_by` as a whole, with the
    keys, should be unique (aggregate by it first where values repeat), because
    rows that share the first column stay together in one range. A null key is a
    key of its own; null order values come last.
    """
    keys = keys or []
    cut = _with_range(df, order_by[0], ranges)
    cells = cut.groupBy(*keys, _RANGE).agg(
        *[F.sum(amount).alias(f"_base_{name}") for name, amount in sums.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(
        *keys,
        _RANGE,
        *[
            F.coalesce(F.sum(f"_base_{name}").over(earlier), F.lit(0)).alias(f"_base_{name}")
            for name in sums
        ],
    )
    inside = (
        Window.partitionBy(*keys, _RANGE)
        .orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return join_null_safe(cut, bases, [*keys, _RANGE]).select(
        *[F.col(c) for c in df.columns],
        *[
            (F.col(f"_base_{name}") + F.sum(amount).over(inside)).alias(name)
            for name, amount in sums.items()
        ],
    )


def exact_median(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Exact median of the non-null values per key, null keys too, from counts per distinct value."""
    keys = keys or []
    counts = written(
        df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")),
        "value_counts",
    )
    ranked = running_totals(counts, [value], {"_upto": F.col("_n")}, keys)
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        ranked = join_null_safe(ranked, totals, keys)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    middle = [F.min(F.when(F.col("_upto") >= rank, F.col(value))) for rank in (low, high)]
    return ranked.groupBy(*keys).agg(((middle[0] + middle[1]) / 2).alias("median"))
