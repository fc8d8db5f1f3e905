"""Run tables: assembly, filters, comparison, ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliospark.plans.ordering import join_null_safe, running_totals
from foliospark.plans.scratch import written

# Tags under this prefix belong to the tracking system itself.
SYSTEM_TAG_PREFIX = "mlflow."

# Metrics and parameters a comparison shows when none are named.
COMPARED_METRICS = ["accuracy", "f1_score", "precision", "recall"]
UNKNOWN = "Unknown"

_COMPARE = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
    "=": lambda c, v: c == v,
}


# ---- assembly ---------------------------------------------------------------


def final_metrics(metrics: DataFrame, order: Sequence[str] = ("step", "ts")) -> DataFrame:
    """Last reported value per run and metric; the value itself breaks full ties.

    `max_by` combines on the map side, so a run with very many reports is not
    brought together in one task.
    """
    latest = F.max_by("value", F.struct(*order, "value"))
    return metrics.groupBy("run_id", "key").agg(latest.alias("value"))


def metric_names(metrics: DataFrame) -> DataFrame:
    return metrics.select("key").distinct()


def key_list(long: DataFrame, max_keys: int = 2000) -> list[str]:
    """Sorted keys of a long table, to name the columns of its wide form."""
    keys = [r["key"] for r in metric_names(long).limit(max_keys + 1).collect()]
    if len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} keys: name the columns you need")
    return sorted(keys)


def wide(
    long: DataFrame, keys: Sequence[str], prefix: str, order: Sequence[str] | None = None
) -> DataFrame:
    """One row per run and one column per key; an absent key is null.

    With `order` the last value of a series is taken in the same aggregate, so
    a metric series needs one shuffle rather than two.
    """

    def cell(key: str) -> Column:
        mine = F.col("key") == key
        if order is None:
            return F.max(F.when(mine, F.col("value")))
        return F.max_by("value", F.when(mine, F.struct(*order, "value")))

    return long.groupBy("run_id").agg(*[cell(k).alias(f"{prefix}{k}") for k in keys])


def assemble_runs(
    runs: DataFrame,
    metrics: DataFrame,
    params: DataFrame,
    tags: DataFrame | None = None,
    metric_keys: Sequence[str] | None = None,
    param_keys: Sequence[str] | None = None,
    tag_keys: Sequence[str] | None = None,
    metric_order: Sequence[str] = ("step", "ts"),
) -> DataFrame:
    """One wide row per run: its columns, `metric_*`, `param_*` and user `tag_*`.

    All inputs are shuffled once, by run.
    """
    metric_keys = key_list(metrics) if metric_keys is None else metric_keys
    param_keys = key_list(params) if param_keys is None else param_keys
    parts = [(metrics, metric_keys, "metric_", metric_order), (params, param_keys, "param_", None)]
    if tags is not None:
        user = tags.where(~F.col("key").startswith(SYSTEM_TAG_PREFIX))
        tag_keys = key_list(user) if tag_keys is None else tag_keys
        parts.append((user, tag_keys, "tag_", None))
    for long, keys, prefix, order in parts:
        if keys:
            runs = runs.join(wide(long, keys, prefix, order), "run_id", "left")
    return runs


def with_maps(runs: DataFrame) -> DataFrame:
    """Add `metrics` and `params` structs, so a filter can say `metrics.x >= 0.3`."""

    def fields(prefix: str) -> list[Column]:
        return [
            F.col(f"`{c}`").alias(c.removeprefix(prefix)) for c in runs.columns if c.startswith(prefix)
        ]

    added = {
        name: F.struct(*fields(prefix))
        for name, prefix in (("metrics", "metric_"), ("params", "param_"))
        if fields(prefix)
    }
    return runs.withColumns(added)


def _quoted(name: str) -> Column:
    """A column by its whole name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def union_experiments(*frames: DataFrame) -> DataFrame:
    """Runs of several experiments; a column one of them lacks is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def join_results(results: DataFrame, metadata: DataFrame, on: str = "run_name") -> DataFrame:
    """Result files with metadata files of the same experiment; either may be absent."""
    return results.join(metadata, on, "full_outer")


def flatten_struct(df: DataFrame, keep: Sequence[str], nested: Sequence[str]) -> DataFrame:
    """Rows `(keep..., key, value)` from the numeric fields of nested structs."""
    pairs = []
    for name in nested:
        for f in df.schema[name].dataType.fields:
            if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte"):
                value = F.col(f"{name}.{f.name}").cast("double")
                pairs.append(F.struct(F.lit(f"{name}_{f.name}").alias("key"), value.alias("value")))
    return df.select(*keep, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


# ---- filters ----------------------------------------------------------------


def by_thresholds(runs: DataFrame, thresholds: dict[str, tuple[float, str]]) -> DataFrame:
    """Runs that pass every `metric: (value, op)`, best test accuracy first, then by run id.

    A missing metric never passes. Names may hold dots and spaces.
    """
    for metric, (value, op) in thresholds.items():
        if op not in _COMPARE:
            raise ValueError(f"unknown operator {op!r} for {metric}")
        runs = runs.where(_COMPARE[op](_quoted(f"metric_{metric}"), value))
    if thresholds and "metric_test_accuracy" in runs.columns:
        runs = runs.orderBy(F.col("metric_test_accuracy").desc_nulls_last(), "run_id")
    return runs


def by_expression(
    runs: DataFrame,
    condition: str | None = None,
    order_by: Sequence[str] = (),
    max_results: int | None = None,
) -> DataFrame:
    """Filter by a SQL condition over `metrics.x` and `params.y`; no hidden row cap.

    Each of `order_by` is `"expression [ASC|DESC]"`; nulls sort last.
    """
    out = with_maps(runs)
    if condition:
        out = out.where(F.expr(condition))
    keys = []
    for item in order_by:
        name, _, direction = item.strip().rpartition(" ")
        direction = direction.upper()
        c = F.expr(name if direction in ("ASC", "DESC") and name else item)
        keys.append(c.desc_nulls_last() if direction == "DESC" and name else c.asc_nulls_last())
    if keys or max_results is not None:
        out = out.orderBy(*keys, "run_id")
    if max_results is not None:
        out = out.limit(max_results)
    return out.drop("metrics", "params")


def by_param(runs: DataFrame, name: str, value: str) -> DataFrame:
    return runs.where(_quoted(f"param_{name}") == value)


def by_ids(runs: DataFrame, ids: DataFrame) -> DataFrame:
    return runs.join(ids.select("run_id"), "run_id", "left_semi")


def by_status(runs: DataFrame, statuses: Sequence[str]) -> DataFrame:
    return runs.where(F.col("status").isin(list(statuses)))


def by_name_contains(runs: DataFrame, parts: Sequence[str]) -> DataFrame:
    wanted = F.lit(False)
    for part in parts:
        wanted = wanted | F.col("run_name").contains(part)
    return runs.where(wanted)


def skip_system_experiments(runs: DataFrame) -> DataFrame:
    return runs.where(~F.col("experiment_name").startswith("_"))


def exclude_run(runs: DataFrame, run_id) -> DataFrame:
    return runs.where(F.col("run_id") != run_id)


def with_runtime(runs: DataFrame, positive: bool = False) -> DataFrame:
    return runs.where(F.col("runtime_min") > 0 if positive else F.col("runtime_min").isNotNull())


# ---- comparison and ranking -------------------------------------------------


def comparison_columns(columns: Sequence[str], metrics: Sequence[str] | None = None) -> list[Column]:
    """Columns of a comparison over a wide run table; `test_m` is preferred over `m`."""
    have = set(columns)

    def metric(m: str) -> Column:
        named = [f"metric_{p}{m}" for p in ("test_", "") if f"metric_{p}{m}" in have]
        return (F.coalesce(*map(_quoted, named)) if named else F.lit(None).cast("double")).alias(m)

    def param(p: str) -> Column:
        return _quoted(f"param_{p}") if f"param_{p}" in have else F.lit(None).cast("string")

    return [
        F.col("run_id"),
        F.coalesce("run_name", F.lit(UNKNOWN)).alias("run_name"),
        F.col("status"),
        *[F.col(c) for c in ("start_time", "end_time", "created", "completed") if c in have],
        *[metric(m) for m in metrics or COMPARED_METRICS],
        F.coalesce(param("algorithm"), F.lit(UNKNOWN)).alias("algorithm"),
        param("test_size").alias("test_size"),
        param("random_state").alias("random_state"),
    ]


def compare_runs(runs: DataFrame, ids: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """One row per found id of `ids(run_id, pos)`, in `pos` order.

    An unknown id is skipped; all lookups are one join.
    """
    found = ids.select("run_id", "pos").join(runs, "run_id")
    return found.select("pos", *comparison_columns(runs.columns, metrics)).orderBy("pos")


def ids_in_order(spark, run_ids: Sequence[str]) -> DataFrame:
    """A caller's id list as the `(run_id, pos)` table `compare_runs` takes."""
    return spark.createDataFrame([(r, i) for i, r in enumerate(run_ids)], "run_id string, pos int")


def best_run(runs: DataFrame, metric: str, maximize: bool = True) -> DataFrame:
    """The best run that has the metric; no row when none has."""
    c = F.col(metric)
    ordered = runs.where(c.isNotNull()).orderBy(c.desc() if maximize else c.asc(), "run_id")
    return ordered.limit(1)


def top_runs(runs: DataFrame, metric: str, n: int) -> DataFrame:
    """Top n by a metric, missing values last, ties by run id."""
    return runs.orderBy(F.col(metric).desc_nulls_last(), "run_id").limit(n)


def leaderboard(runs: DataFrame, metric: str = "metric_test_accuracy", n: int = 10) -> DataFrame:
    """Top n runs with their place, shown with the columns of a comparison."""
    first = Window.partitionBy(F.lit(1)).orderBy(F.col(metric).desc_nulls_last(), "run_id")
    placed = top_runs(runs, metric, n).withColumn("pos", F.row_number().over(first))  # n rows
    return placed.select("pos", *comparison_columns(runs.columns))


def newest_runs(runs: DataFrame, n: int, statuses: Sequence[str] | None = None) -> DataFrame:
    kept = by_status(runs, statuses) if statuses else runs
    return kept.orderBy(F.col("created").desc_nulls_last(), "run_id").limit(n)


#: Up to this many rows of a group, Spark itself cuts every group before the shuffle.
_GROUP_LIMIT = 1000
#: Size of a quantile sketch, and a share of the rows that its ranks are surely not off by.
_SKETCH_SIZE, _RANK_ERROR = 2000, 0.005


def _ordinal(df: DataFrame, by: str) -> Column:
    """The column as a number with the same order."""
    kind = dict(df.dtypes)[by]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(by).cast("timestamp"))
    if kind == "date":
        return F.unix_date(by)
    return F.col(by)


def at_least_nth(df: DataFrame, group: str, by: str, n: int) -> DataFrame:
    """The rows of each group that may be among its n with the largest `by`, without sorting.

    A quantile sketch of each group gives a value that the n-th is surely not below.
    The bound is counted before it is used, so no such row is lost; groups of fewer
    than n values stay whole. Rows equal to the bound stay.
    """
    value = _ordinal(df, by).cast("double")
    number = F.when(~F.isnan(value), value)
    sketched = df.groupBy(group).agg(
        F.count(number).alias("_n"), F.kll_sketch_agg_double(number, F.lit(_SKETCH_SIZE)).alias("_sketch")
    )
    # a sketch is asked for fixed ranks: the shares above them shrink by a sixth from one to the next
    ranks = F.array(*[F.lit(1 - 2 ** (-i / 4)) for i in range(41)])
    above = F.lit(n) / F.col("_n") + _RANK_ERROR
    step = F.least(F.floor(-4 * F.log2(above)), F.lit(40)).cast("int")
    bounds = sketched.where((F.col("_n") > n) & (above < 1)).select(
        group, F.get(F.kll_sketch_get_quantile_double("_sketch", ranks), step).alias("_bound")
    )
    bounds = written(bounds, "bounds")
    reached = join_null_safe(df.select(group, number.alias("_v")), bounds, [group]).where("_v >= _bound")
    enough = reached.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= n).select(group)
    bounds = written(join_null_safe(bounds, enough, [group], "left_semi"), "bounds")
    kept = join_null_safe(df, bounds, [group], "left").where(
        F.col("_bound").isNull() | F.isnan(value) | (value >= F.col("_bound"))
    )
    return kept.drop("_bound")


def top_per_group(df: DataFrame, group: str, by: str, tie: str, n: int) -> DataFrame:
    """The first n rows of every group by `by` descending, nulls last, then `tie`, with their `rank`.

    Up to a thousand, `row_number() <= n` lets Spark cut every group to n rows per
    task before the shuffle. Beyond, rows below the n-th value are dropped by a
    sketch first and the rest are ranked over ranges, so no task holds a group.
    """
    if n <= _GROUP_LIMIT:
        order = Window.partitionBy(group).orderBy(F.col(by).desc_nulls_last(), F.col(tie))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    kept = at_least_nth(df, group, by, n)
    value = _ordinal(kept, by)
    if dict(kept.dtypes)[by] in ("double", "float"):
        value = F.when(F.isnan(value), float("inf")).otherwise(value)
    ranked = running_totals(
        kept.withColumn("_down", -value), ["_down", tie], {"rank": F.lit(1).cast("bigint")}, [group]
    )
    return ranked.where(F.col("rank") <= n).drop("_down").withColumn("rank", F.col("rank").cast("int"))


def top_per_algorithm(runs: DataFrame, algorithms: Sequence[str], n: int = 10) -> DataFrame:
    wanted = runs.where(F.col("algorithm").isin(list(algorithms)))
    return top_per_group(wanted, "algorithm", "created", "run_id", n)


def union_algorithms(runs: DataFrame, algorithms: Sequence[str]) -> DataFrame:
    """Run ids of the named algorithms with the place of the name; a repeated name repeats its runs.

    One scan: each run is repeated for the places of its own algorithm.
    """
    places: dict[str, list[int]] = {}
    for position, name in enumerate(algorithms):
        places.setdefault(name, []).append(position)
    lists = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    wanted = runs.where(F.col("algorithm").isin(list(places)))
    return wanted.select(F.explode(lists[F.col("algorithm")]).alias("list"), "run_id")


def best_by_metric(runs: DataFrame, metric: str) -> DataFrame:
    """The run with the highest metric; absent counts as 0, the lowest id wins ties."""
    value = F.coalesce(F.col(metric), F.lit(0.0))
    best = F.min_by(
        F.struct("run_id", "run_name", value.alias("best_value")), F.struct(-value, F.col("run_id"))
    )
    return runs.agg(best.alias("b")).where(F.col("b").isNotNull()).select("b.*")
