"""Queries over runs: labels, filters, assembly, comparison, ranking, versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import scores
from foliospark.operators import runs as ops
from foliospark.operators import stats, tables, versions
from foliospark.plans.scratch import written
from foliospark.queries import views
from foliospark.queries.registry import query
from foliospark.queries.views import METRIC_KEYS, PARAM_KEYS, table, with_views

METRIC_ORDER = ("step", "ts")


def final_metrics(spark, folder):
    return ops.final_metrics(views.run_metrics(spark, folder), METRIC_ORDER)


def wide_runs(spark, folder, ids=None):
    """All runs, or those of a table of ids, assembled from their long tables."""
    parts = [view(spark, folder) for view in (views.runs, views.run_metrics, views.run_params)]
    if ids is not None:
        parts = [part.join(ids, "run_id", "left_semi") for part in parts]
    return ops.assemble_runs(
        *parts,
        metric_keys=METRIC_KEYS,
        param_keys=PARAM_KEYS,
        metric_order=METRIC_ORDER,
    )


def _one_metric(spark, folder, key):
    """Last value of one metric per run that has it, before anything is assembled."""
    reports = views.run_metrics(spark, folder).where(F.col("key") == key)
    return ops.wide(reports, [key], "metric_", METRIC_ORDER)


# ---- labels and scalar columns ---------------------------------------------


@query("runtime_minutes", with_views("runs", "SELECT run_id, round_even(runtime_min, 2) AS runtime_min FROM runs"))
def _(spark, folder):
    return views.runs(spark, folder).select("run_id", scores.round_even("runtime_min", 2).alias("runtime_min"))


_WIDTHS = [50, 40, 30, 25, 20, 15, 10, 8]


@query(
    "short_label",
    with_views(
        "publications",
        "SELECT doc_id, "
        + ", ".join(
            f"CASE WHEN len(abstract) > {w} THEN concat(substr(abstract, 1, {w}), '...') ELSE abstract END AS label_{w}"
            for w in _WIDTHS
        )
        + " FROM publications",
    ),
)
def _(spark, folder):
    return views.publications(spark, folder).select(
        "doc_id", *[scores.short_label("abstract", w).alias(f"label_{w}") for w in _WIDTHS]
    )


@query("fmt_minute", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events")
def _(spark, folder):
    return table(spark, folder, "events").select("event_id", scores.minute_stamp("ts").alias("minute"))


_FAMILY_SQL = (
    "CASE WHEN run_name LIKE 'RF%' THEN 'Random Forest' WHEN run_name LIKE 'SVM%' THEN 'SVM' "
    "ELSE 'Logistic Regression' END"
)


@query(
    "algorithm_family",
    with_views(
        "runs",
        f"SELECT run_id, {_FAMILY_SQL} AS family, coalesce(CASE WHEN run_id % 2 = 0 THEN algorithm END, "
        f"{_FAMILY_SQL}) AS algorithm FROM runs",
    ),
)
def _(spark, folder):
    known = F.when(F.col("run_id") % 2 == 0, F.col("algorithm"))
    return views.runs(spark, folder).select(
        "run_id",
        scores.algorithm_family("run_name").alias("family"),
        scores.algorithm_family("run_name", known).alias("algorithm"),
    )


@query(
    "metric_key",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = l_linestatus THEN l_linestatus "
    "ELSE concat(l_returnflag, '_', l_linestatus) END AS key FROM lineitem",
)
def _(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", scores.metric_key("l_returnflag", "l_linestatus").alias("key")
    )


@query(
    "metric_name_clean",
    with_views(
        "run_metrics",
        "SELECT replace(replace(replace(concat('Test Metrics_', key), 'Test Metrics_', ''), 'test_', ''), "
        "'metric_', '') AS name, count(*) AS n FROM run_metrics GROUP BY 1",
    ),
)
def _(spark, folder):
    titled = F.concat(F.lit("Test Metrics_"), F.col("key"))
    return (
        views.run_metrics(spark, folder)
        .groupBy(scores.metric_name_clean(titled).alias("name"))
        .agg(F.count("*").alias("n"))
    )


_TIER_SQL = (
    "CASE WHEN {a} >= 0.9 THEN 'high_quality' WHEN {a} >= 0.8 THEN 'medium_quality' ELSE 'low_quality' END"
)


@query(
    "quality_tier",
    with_views("runs", f"SELECT run_id, {_TIER_SQL.format(a='test_accuracy')} AS tier FROM runs"),
)
def _(spark, folder):
    return views.runs(spark, folder).select("run_id", scores.quality_tier("test_accuracy").alias("tier"))


@query(
    "performance_tag",
    with_views(
        "runs",
        "SELECT run_id, array_to_string(list_filter([CASE WHEN a >= 0.9 THEN 'high_performance' END, "
        "concat('algorithm_', algorithm), CASE WHEN a > 0 THEN concat('accuracy_', format('{:.3f}', a)) END, "
        f"concat('v', CAST(experiment_id AS VARCHAR)), {_TIER_SQL.format(a='a')}], lambda x: x IS NOT NULL), ' ') "
        "AS tags FROM (SELECT *, coalesce(test_f1_score, 0) AS a FROM runs)",
    ),
)
def _(spark, folder):
    return views.runs(spark, folder).select(
        "run_id",
        F.array_join(
            scores.performance_tags("algorithm", "test_f1_score", "experiment_id"), " "
        ).alias("tags"),
    )


@query(
    "threshold_flags",
    with_views(
        "runs",
        "SELECT run_id, a > 0.7 AS accuracy_passed, f > 0.7 AS f1_passed, "
        "CASE WHEN a > 0.7 AND f > 0.7 THEN 'good' ELSE 'needs_improvement' END AS overall_quality "
        "FROM (SELECT run_id, test_accuracy AS a, coalesce(test_f1_score, 0) AS f FROM runs)",
    ),
)
def _(spark, folder):
    return views.runs(spark, folder).select(
        "run_id", *scores.threshold_flags("test_accuracy", "test_f1_score")
    )


def _result_struct(runs):
    return runs.selectExpr(
        "run_id",
        "named_struct('accuracy', test_accuracy, 'f1_score', test_f1_score) as test_metrics",
        "named_struct('training_samples', experiment_id, 'algorithm', algorithm) as model_info",
    )


@query(
    "flatten_nested_metrics",
    with_views(
        "runs",
        "SELECT run_id, 'test_metrics_accuracy' AS key, test_accuracy AS value FROM runs "
        "UNION ALL SELECT run_id, 'test_metrics_f1_score', test_f1_score FROM runs WHERE test_f1_score IS NOT NULL "
        "UNION ALL SELECT run_id, 'model_info_training_samples', experiment_id::DOUBLE FROM runs",
    ),
)
def _(spark, folder):
    return ops.flatten_struct(
        _result_struct(views.runs(spark, folder)), ["run_id"], ["test_metrics", "model_info"]
    )


@query(
    "round_metrics",
    with_views(
        "run_metrics",
        "SELECT run_id, key, step, round_even(value, 4) AS value4, round_even(value, 3) AS value3 FROM run_metrics",
    ),
)
def _(spark, folder):
    return views.run_metrics(spark, folder).select(
        "run_id", "key", "step", scores.round_even("value", 4).alias("value4"), scores.round_even("value", 3).alias("value3")
    )


# ---- filters ----------------------------------------------------------------


@query(
    "runs_by_thresholds",
    with_views(
        "wide_runs",
        "SELECT run_id, run_name, status, metric_test_accuracy, metric_test_f1_score FROM wide_runs "
        "WHERE metric_test_accuracy >= 0.3 AND metric_test_f1_score < 0.6 AND metric_loss > 0.1",
    ),
)
def _(spark, folder):
    passed = ops.by_thresholds(
        wide_runs(spark, folder),
        {"test_accuracy": (0.3, ">="), "test_f1_score": (0.6, "<"), "loss": (0.1, ">")},
    )
    return passed.select("run_id", "run_name", "status", "metric_test_accuracy", "metric_test_f1_score")


@query(
    "runs_by_expression",
    with_views(
        "wide_runs",
        "SELECT run_id, run_name, metric_test_accuracy, param_algorithm FROM wide_runs "
        "WHERE metric_test_accuracy >= 0.3 AND param_algorithm = '2-HIGH'",
    ),
)
def _(spark, folder):
    found = ops.by_expression(
        wide_runs(spark, folder), "metrics.test_accuracy >= 0.3 AND params.algorithm = '2-HIGH'"
    )
    return found.select("run_id", "run_name", "metric_test_accuracy", "param_algorithm")


@query(
    "runs_by_param",
    with_views("wide_runs", "SELECT run_id, param_random_state FROM wide_runs WHERE param_test_size = '0.3'"),
)
def _(spark, folder):
    return ops.by_param(wide_runs(spark, folder), "test_size", "0.3").select("run_id", "param_random_state")


def _requested(spark, folder):
    """Run ids another table asks for, in its order; not every one exists."""
    return table(spark, folder, "events").selectExpr("event_id * 2 as run_id", "event_id as pos")


@query(
    "runs_by_ids",
    with_views(
        "runs", "SELECT run_id, run_name FROM runs WHERE run_id IN (SELECT event_id * 2 FROM events)"
    ),
)
def _(spark, folder):
    return ops.by_ids(views.runs(spark, folder).select("run_id", "run_name"), _requested(spark, folder))


@query(
    "runs_by_status",
    with_views("runs", "SELECT run_id, status FROM runs WHERE status IN ('completed', 'failed')"),
)
def _(spark, folder):
    return ops.by_status(views.runs(spark, folder), ["completed", "failed"]).select("run_id", "status")


@query(
    "runs_by_name_contains",
    with_views(
        "runs", "SELECT run_id, run_name FROM runs WHERE contains(run_name, 'RF_1') OR contains(run_name, '77')"
    ),
)
def _(spark, folder):
    return ops.by_name_contains(views.runs(spark, folder), ["RF_1", "77"]).select("run_id", "run_name")


@query(
    "skip_system_experiments",
    with_views("runs", "SELECT run_id, experiment_name FROM runs WHERE NOT starts_with(experiment_name, '_')"),
)
def _(spark, folder):
    return ops.skip_system_experiments(views.runs(spark, folder)).select("run_id", "experiment_name")


@query("exclude_self", with_views("runs", "SELECT run_id, run_name FROM runs WHERE run_id <> 7"))
def _(spark, folder):
    return ops.exclude_run(views.runs(spark, folder), 7).select("run_id", "run_name")


@query(
    "runtime_present",
    with_views("runs", "SELECT run_id, round_even(runtime_min, 2) AS runtime_min FROM runs WHERE runtime_min > 0"),
)
def _(spark, folder):
    kept = ops.with_runtime(views.runs(spark, folder), positive=True)
    return kept.select("run_id", scores.round_even("runtime_min", 2).alias("runtime_min"))


_PERFORMANCE_SQL = "regexp_matches(lower(key), 'accuracy|f1|precision|recall')"


@query(
    "performance_columns",
    with_views(
        "run_metrics",
        f"SELECT run_id, key, step, value FROM run_metrics WHERE {_PERFORMANCE_SQL}",
    ),
)
def _(spark, folder):
    metrics = views.run_metrics(spark, folder)
    return metrics.where(scores.is_performance_metric("key")).select("run_id", "key", "step", "value")


@query(
    "accuracy_column",
    with_views(
        "run_metrics",
        "SELECT min(key) AS key FROM run_metrics WHERE contains(lower(key), 'accuracy') "
        "AND NOT contains(lower(key), 'cv') AND NOT contains(lower(key), 'std')",
    ),
)
def _(spark, folder):
    return tables.first_accuracy_metric(views.run_metrics(spark, folder))


@query(
    "status_partition",
    with_views(
        "sweep_results",
        "SELECT run_id, 'successful' AS part FROM sweep_results WHERE status = 'success' "
        "UNION ALL SELECT run_id, 'failed' FROM sweep_results WHERE status <> 'success'",
    ),
)
def _(spark, folder):
    good = F.col("status") == "success"
    return views.sweep_results(spark, folder).select(
        "run_id", F.when(good, "successful").otherwise("failed").alias("part")
    )


# ---- joins and assembly -----------------------------------------------------


@query("run_assembly", with_views("wide_runs", "SELECT * EXCLUDE (algorithm, runtime_min) FROM wide_runs"))
def _(spark, folder):
    return wide_runs(spark, folder).drop("algorithm", "runtime_min")


@query(
    "run_tags",
    with_views(
        "runs",
        "SELECT run_id, run_name, concat('c', CAST(baseline_id AS VARCHAR)) AS tag_owner, "
        "algorithm AS param_algorithm FROM runs",
    ),
)
def _(spark, folder):
    assembled = ops.assemble_runs(
        views.runs(spark, folder).select("run_id", "run_name"),
        views.run_metrics(spark, folder),
        views.run_params(spark, folder),
        views.run_tags(spark, folder),
        metric_keys=["loss"],
        param_keys=["algorithm"],
        tag_keys=["owner"],
        metric_order=METRIC_ORDER,
    )
    return assembled.drop("metric_loss")


@query(
    "result_meta_join",
    """SELECT coalesce(r.run_name, m.run_name) AS run_name, r.accuracy, m.param_algorithm FROM
         (SELECT concat('exp_', CAST(o_orderkey AS VARCHAR)) AS run_name, o_totalprice / 500000e0 AS accuracy
          FROM orders WHERE o_orderstatus <> 'P') r
       FULL JOIN
         (SELECT concat('exp_', CAST(o_orderkey AS VARCHAR)) AS run_name, o_orderpriority AS param_algorithm
          FROM orders WHERE o_orderpriority <> '5-LOW') m ON r.run_name = m.run_name""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    name = "concat('exp_', cast(o_orderkey as string)) as run_name"
    results = orders.where("o_orderstatus <> 'P'").selectExpr(name, "o_totalprice / 500000e0 as accuracy")
    metadata = orders.where("o_orderpriority <> '5-LOW'").selectExpr(name, "o_orderpriority as param_algorithm")
    return ops.join_results(results, metadata)


_COMPARISON_SQL = (
    "run_id, run_name, status, created, completed, metric_test_accuracy AS accuracy, "
    "metric_test_f1_score AS f1_score, metric_test_precision AS precision, metric_test_recall AS recall, "
    "coalesce(param_algorithm, 'Unknown') AS algorithm, param_test_size AS test_size, "
    "param_random_state AS random_state"
)


@query(
    "compare_runs",
    with_views(
        "wide_runs",
        f"SELECT e.event_id AS pos, {_COMPARISON_SQL} FROM events e JOIN wide_runs ON run_id = e.event_id * 2",
    ),
)
def _(spark, folder):
    requested = _requested(spark, folder)
    ids = written(requested.select("run_id").distinct(), "requested")
    return ops.compare_runs(wide_runs(spark, folder, ids), requested)


@query(
    "baseline_delta",
    with_views(
        "runs",
        "SELECT c.run_id, c.baseline_id, coalesce(b.test_accuracy, 0) AS baseline_accuracy, "
        "coalesce(c.test_accuracy, 0) - coalesce(b.test_accuracy, 0) AS accuracy_improvement "
        "FROM runs c LEFT JOIN runs b ON b.run_id = c.baseline_id AND b.status = 'completed'",
    ),
)
def _(spark, folder):
    current = views.runs(spark, folder)
    completed = ops.by_status(views.runs(spark, folder), ["completed"])
    return versions.baseline_delta(current, completed)


@query(
    "latest_model_lookup",
    with_views(
        "model_versions",
        """SELECT name, version, stage, accuracy, f1_score FROM model_versions
           WHERE name IN (SELECT concat('model_', CAST(c_custkey AS VARCHAR)) FROM customer)
           QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1""",
    ),
)
def _(spark, folder):
    names = table(spark, folder, "customer").selectExpr("concat('model_', cast(c_custkey as string)) as name")
    return versions.latest_model_lookup(names, views.model_versions(spark, folder))


# ---- windows by meaning -----------------------------------------------------


@query("final_metric_value", with_views("final_metrics", "SELECT run_id, key, value FROM final_metrics"))
def _(spark, folder):
    return final_metrics(spark, folder)


@query(
    "minmax_matrix",
    with_views(
        "final_metrics",
        "SELECT run_id, key, value, (value - min(value) OVER w) / "
        "nullif(max(value) OVER w - min(value) OVER w, 0) AS scaled FROM final_metrics "
        "WINDOW w AS (PARTITION BY key)",
    ),
)
def _(spark, folder):
    return stats.minmax_long(final_metrics(spark, folder))


_FILLED = [f"metric_{k}" for k in METRIC_KEYS[:4]]


@query(
    "minmax_matrix_filled",
    with_views(
        "wide_runs",
        "SELECT run_id, "
        + ", ".join(
            f"coalesce((coalesce({c}, 0) - min(coalesce({c}, 0)) OVER ()) / nullif(max(coalesce({c}, 0)) OVER () "
            f"- min(coalesce({c}, 0)) OVER (), 0), 0) AS {c}"
            for c in _FILLED
        )
        + " FROM wide_runs",
    ),
)
def _(spark, folder):
    return stats.minmax_wide(wide_runs(spark, folder).select("run_id", *_FILLED), _FILLED)


@query(
    "top_n_per_algorithm",
    with_views(
        "runs",
        "SELECT run_id, algorithm, created, row_number() OVER (PARTITION BY algorithm ORDER BY created DESC, run_id)"
        "::INT AS rank FROM runs WHERE algorithm IN ('1-URGENT', '2-HIGH', '5-LOW') QUALIFY rank <= 10",
    ),
)
def _(spark, folder):
    top = ops.top_per_algorithm(views.runs(spark, folder), ["1-URGENT", "2-HIGH", "5-LOW"], 10)
    return top.select("run_id", "algorithm", "created", "rank")


@query(
    "top_5000_per_status",
    with_views(
        "runs",
        "SELECT run_id, status, test_accuracy, row_number() OVER (PARTITION BY status ORDER BY test_accuracy DESC "
        "NULLS LAST, run_id)::INT AS rank FROM runs QUALIFY rank <= 5000",
    ),
)
def _(spark, folder):
    """Far more rows of a group than a task could be cut to: a sketch drops the rest."""
    runs = views.runs(spark, folder).select("run_id", "status", "test_accuracy")
    return ops.top_per_group(runs, "status", "test_accuracy", "run_id", 5000)


@query(
    "latest_version",
    with_views("model_versions", "SELECT name, stage, max(version) AS version FROM model_versions GROUP BY ALL"),
)
def _(spark, folder):
    return versions.latest_versions(views.model_versions(spark, folder))


def _stage_events(spark, folder):
    return table(spark, folder, "lineitem").selectExpr(
        "concat('model_', cast(l_suppkey as string)) as name",
        "l_partkey as version",
        "case l_returnflag when 'R' then 'Production' when 'A' then 'Staging' else 'None' end as stage",
        # one sortable moment per event, so that no two events tie
        "unix_micros(cast(l_shipdate as timestamp)) * 10 + l_linenumber as moment",
        "l_orderkey",
        "l_linestatus = 'F' as archive_existing",
    )


_STAGE_EVENTS_SQL = """
    WITH events_ AS (
      SELECT concat('model_', CAST(l_suppkey AS VARCHAR)) AS name, l_partkey AS version,
             CASE l_returnflag WHEN 'R' THEN 'Production' WHEN 'A' THEN 'Staging' ELSE 'None' END AS stage,
             epoch_us(l_shipdate) * 10 + l_linenumber AS moment, l_orderkey,
             l_linestatus = 'F' AS archive_existing FROM lineitem),
    e AS (SELECT name, version, moment, max(stage) AS stage, bool_or(archive_existing) AS archive_existing
          FROM events_ GROUP BY ALL),
    own AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY name, version ORDER BY moment DESC) = 1)
    SELECT name, version, CASE WHEN EXISTS (
             SELECT 1 FROM e x WHERE x.name = own.name AND x.stage = own.stage
                AND x.version <> own.version AND x.archive_existing AND x.moment > own.moment)
           THEN 'Archived' ELSE stage END AS stage FROM own"""


@query("stage_transition", _STAGE_EVENTS_SQL)
def _(spark, folder):
    events = (
        _stage_events(spark, folder)
        .groupBy("name", "version", F.col("moment").alias("ts"))
        .agg(F.max("stage").alias("stage"), F.max("archive_existing").alias("archive_existing"))
    )
    return versions.stage_after_events(events)


@query(
    "model_version_count",
    with_views(
        "model_versions",
        "SELECT name, count(*) AS existing, count(*) + 1 AS next_version FROM model_versions GROUP BY 1",
    ),
)
def _(spark, folder):
    return versions.next_version(views.model_versions(spark, folder))


@query(
    "model_version_numbers",
    """SELECT concat('model_', CAST(o_custkey AS VARCHAR)) AS name, o_orderkey AS registered,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS version FROM orders""",
)
def _(spark, folder):
    registrations = table(spark, folder, "orders").selectExpr(
        "concat('model_', cast(o_custkey as string)) as name", "o_orderkey as registered"
    )
    return versions.number_versions(registrations)


# ---- sort, limit, top-k -----------------------------------------------------


@query(
    "best_run",
    with_views(
        "wide_runs",
        "(SELECT 'max' AS kind, run_id, metric_test_accuracy FROM wide_runs WHERE metric_test_accuracy IS NOT NULL "
        "ORDER BY metric_test_accuracy DESC, run_id LIMIT 1) UNION ALL "
        "(SELECT 'min', run_id, metric_loss FROM wide_runs WHERE metric_loss IS NOT NULL "
        "ORDER BY metric_loss, run_id LIMIT 1)",
    ),
)
def _(spark, folder):
    accuracy, loss = (_one_metric(spark, folder, key) for key in ("test_accuracy", "loss"))
    high = ops.best_run(accuracy, "metric_test_accuracy").selectExpr("'max' as kind", "run_id", "metric_test_accuracy")
    low = ops.best_run(loss, "metric_loss", maximize=False).selectExpr("'min' as kind", "run_id", "metric_loss")
    return high.union(low)


@query(
    "leaderboard",
    with_views(
        "wide_runs",
        f"SELECT row_number() OVER (ORDER BY metric_test_accuracy DESC NULLS LAST, run_id)::INT AS pos, "
        f"{_COMPARISON_SQL} FROM wide_runs ORDER BY metric_test_accuracy DESC NULLS LAST, run_id LIMIT 10",
    ),
)
def _(spark, folder):
    ranked = views.runs(spark, folder).select("run_id").join(
        _one_metric(spark, folder, "test_accuracy"), "run_id", "left"
    )
    ids = written(ops.top_runs(ranked, "metric_test_accuracy", 10).select("run_id"), "leaders")
    return ops.leaderboard(wide_runs(spark, folder, ids))


@query(
    "top5",
    with_views(
        "sweep_results",
        " UNION ALL ".join(
            f"(SELECT '{c}' AS ranking, row_number() OVER (ORDER BY {c} DESC NULLS LAST, run_id)::INT AS place, "
            f"run_id, run_name, algorithm, {c} AS score FROM sweep_results WHERE status = 'success' "
            f"ORDER BY {c} DESC NULLS LAST, run_id LIMIT 5)"
            for c in ("test_accuracy", "test_f1_score")
        ),
    ),
)
def _(spark, folder):
    return tables.top_by_scores(views.sweep_results(spark, folder), ["test_accuracy", "test_f1_score"])


@query(
    "best_by_metric",
    with_views(
        "runs",
        "SELECT run_id, run_name, coalesce(test_f1_score, 0) AS best_value FROM runs "
        "ORDER BY coalesce(test_f1_score, 0) DESC, run_id LIMIT 1",
    ),
)
def _(spark, folder):
    return ops.best_by_metric(views.runs(spark, folder), "test_f1_score")


_TABLE_METRICS = ["metric_test_accuracy", "metric_test_f1_score", "metric_loss"]


@query(
    "comparison_table",
    with_views(
        "wide_runs",
        "SELECT CASE WHEN len(run_name) > 50 THEN concat(substr(run_name, 1, 50), '...') ELSE run_name END "
        "AS experiment, concat(substr(CAST(run_id AS VARCHAR), 1, 8), '...') AS task_id, status, "
        "round_even(nullif(runtime_min, 0), 2) AS runtime_min, strftime(created, '%Y-%m-%d %H:%M') AS created, "
        + ", ".join(f"round_even({c}, 4) AS {c}" for c in _TABLE_METRICS)
        + " FROM wide_runs",
    ),
)
def _(spark, folder):
    return tables.comparison_table(wide_runs(spark, folder), _TABLE_METRICS)


@query(
    "summary_table",
    with_views(
        "wide_runs",
        "SELECT run_id, run_name AS experiment, status, "
        "round_even(CASE WHEN runtime_min > 0 THEN runtime_min END, 2) AS runtime_min, "
        "strftime(created, '%Y-%m-%d %H:%M') AS created, "
        "round_even(coalesce(metric_cv_mean_accuracy, metric_test_accuracy), 4) AS accuracy, "
        "round_even(metric_test_f1_score, 4) AS f1_score FROM wide_runs",
    ),
)
def _(spark, folder):
    return tables.summary_table(views.runs(spark, folder), final_metrics(spark, folder))


@query(
    "bar_top10",
    with_views(
        "final_metrics",
        "SELECT run_id, key, value, row_number() OVER (PARTITION BY key ORDER BY value DESC, run_id)::INT AS rank "
        "FROM final_metrics QUALIFY rank <= 10",
    ),
)
def _(spark, folder):
    return tables.bar_top(final_metrics(spark, folder))


@query(
    "newest_runs",
    with_views(
        "runs",
        "SELECT run_id, run_name, created FROM runs WHERE status = 'completed' ORDER BY created DESC, run_id LIMIT 20",
    ),
)
def _(spark, folder):
    return ops.newest_runs(views.runs(spark, folder), 20, ["completed"]).select("run_id", "run_name", "created")


@query(
    "sort_by_time",
    with_views("runs", "SELECT run_id, round_even(runtime_min, 2) AS runtime_min FROM runs WHERE runtime_min IS NOT NULL"),
)
def _(spark, folder):
    timed = ops.with_runtime(views.runs(spark, folder)).orderBy("runtime_min", "run_id")
    return timed.select("run_id", scores.round_even("runtime_min", 2).alias("runtime_min"))


@query(
    "result_table",
    with_views(
        "runs",
        f"SELECT run_name, {_FAMILY_SQL} AS family, test_accuracy AS accuracy, "
        "coalesce(test_f1_score, 0) AS f1_score FROM runs",
    ),
)
def _(spark, folder):
    return tables.result_table(views.runs(spark, folder), "test_accuracy", "test_f1_score")


# ---- set operations ---------------------------------------------------------


@query(
    "union_experiments",
    with_views(
        "runs",
        "SELECT run_id, run_name, test_accuracy, NULL::DOUBLE AS test_f1_score FROM runs WHERE experiment_id < 5 "
        "UNION ALL SELECT run_id, run_name, NULL, test_f1_score FROM runs WHERE experiment_id >= 5",
    ),
)
def _(spark, folder):
    everything = views.runs(spark, folder)
    first = everything.where("experiment_id < 5").select("run_id", "run_name", "test_accuracy")
    second = everything.where("experiment_id >= 5").select("run_id", "run_name", "test_f1_score")
    return ops.union_experiments(first, second)


@query(
    "union_algorithms",
    with_views(
        "runs",
        "SELECT 0 AS list, run_id FROM runs WHERE algorithm = '2-HIGH' UNION ALL "
        "SELECT 1, run_id FROM runs WHERE algorithm = '5-LOW' UNION ALL "
        "SELECT 2, run_id FROM runs WHERE algorithm = '2-HIGH'",
    ),
)
def _(spark, folder):
    return ops.union_algorithms(views.runs(spark, folder), ["2-HIGH", "5-LOW", "2-HIGH"])


@query("metric_name_union", with_views("run_metrics", "SELECT DISTINCT key FROM run_metrics"))
def _(spark, folder):
    return ops.metric_names(views.run_metrics(spark, folder))
